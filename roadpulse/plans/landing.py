"""Tables landed from `events` through the real ingestion path, shared by a process's queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from roadpulse.operators.encode import envelopes
from roadpulse.options import Options
from roadpulse.plans.steps import events_path, messages, read_steps, stream_steps
from roadpulse.schemas import STEP_KEY, TOPICS
from roadpulse.session import pin_utc, scratch_path
from roadpulse.sources.files import modified, write_log
from roadpulse.sources.landed import analyze, bucketed, read_landed
from roadpulse.streaming.ingest import start_all, supervise

# By application, folder and the time the events last changed.
_options: dict[tuple[str, str, int], Options] = {}
_landed: dict[tuple[str, str, int], set[str]] = {}
_logs: dict[tuple[str, str, int], str] = {}
_buckets: dict[tuple[str, str, int, str], str] = {}

#: Enough for the tables at hand; a bucket should come to some 256 MB.
BUCKETS = 8


def _version(spark: SparkSession, sf_dir: str) -> tuple[str, str, int]:
    return (spark.sparkContext.applicationId, sf_dir, modified(spark, events_path(sf_dir)))


def event_source(spark: SparkSession, sf_dir: str):
    """Topic to stream of messages, straight from the events table."""
    return lambda topic: messages(stream_steps(spark, sf_dir), topic)


def fresh_options(spark: SparkSession, name: str, **changes) -> Options:
    return Options(base_uri=scratch_path(spark, name), trigger="available", **changes)


def land_topics(
    spark: SparkSession, sf_dir: str, options: Options, topics: Sequence[str] = TOPICS
) -> None:
    supervise(start_all(spark, options, topics, event_source(spark, sf_dir)))


def landed_options(spark: SparkSession, sf_dir: str, topics: Sequence[str] = TOPICS) -> Options:
    """Where the process's landed set is, after landing those of ``topics`` not there yet."""
    pin_utc(spark)
    key = _version(spark, sf_dir)
    options = _options.setdefault(key, fresh_options(spark, "landed"))
    done = _landed.setdefault(key, set())
    missing = [t for t in topics if t not in done]
    if missing:
        land_topics(spark, sf_dir, options, missing)
        done.update(missing)
    return options


def landed(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    return read_landed(spark, landed_options(spark, sf_dir, [topic]), topic)


def landed_buckets(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """A topic's landed set as a table in buckets of steps, with statistics; made once per process."""
    options = landed_options(spark, sf_dir, [topic])
    key = (*_version(spark, sf_dir), topic)
    if key not in _buckets:
        path = scratch_path(spark, f"bucketed-{topic}")
        name = path.rsplit("/", 1)[1].replace("-", "_")
        bucketed(spark, options, topic, name, path, BUCKETS)
        analyze(spark, [name], {name: STEP_KEY})
        _buckets[key] = name
    return spark.table(_buckets[key])


def log_path(spark: SparkSession, sf_dir: str) -> str:
    """A message log of all five topics, written once per process in one pass over the events."""
    pin_utc(spark)
    key = _version(spark, sf_dir)
    if key not in _logs:
        path = scratch_path(spark, "log")
        sent = envelopes(read_steps(spark, sf_dir), "partition", "offset", "timestamp")
        write_log(sent, path)
        _logs[key] = path
    return _logs[key]
