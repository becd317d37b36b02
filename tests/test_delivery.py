"""Reports of delivery against what arrived, over several batches, runs and failures."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roadpulse.operators.encode import envelopes
from roadpulse.options import Options
from roadpulse.plans.steps import read_steps
from roadpulse.session import scratch_path
from roadpulse.streaming.delivery import missing, read_failures, read_report
from roadpulse.streaming.ingest import run
from roadpulse.streaming.publish import publish_reported

FIGURES = ["topic", "messages", "keyless", "empty", "bytes"]


def _totals(report):
    sums = [F.sum(c).alias(c) for c in FIGURES[1:]]
    return sorted((tuple(r) for r in report.groupBy("topic").agg(*sums).select(FIGURES).collect()), key=str)


def _arrived(log):
    found = log.groupBy("topic").agg(
        F.count("*").alias("messages"),
        F.count_if(F.col("key").isNull()).alias("keyless"),
        F.count_if(F.col("value").isNull()).alias("empty"),
        F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"),
    )
    known = list(Options().topic_names.values())
    return _totals(found.withColumn("topic", F.when(F.col("topic").isin(known), F.col("topic"))))


@pytest.fixture
def outbox(spark, sf_dir):
    """A folder of messages, some without key or value, one topic nobody knows; and how it is published."""
    base = scratch_path(spark, "outbox")
    sent = envelopes(read_steps(spark, sf_dir), "event_id", "partition", "offset", "timestamp")
    sent = sent.withColumn("key", F.when(F.col("event_id") % 7 > 0, F.col("key")))
    sent = sent.withColumn("value", F.when(F.col("event_id") % 11 > 0, F.col("value")))
    sent = sent.withColumn("topic", F.when(F.col("event_id") % 13 > 0, F.col("topic")).otherwise("elsewhere"))
    sent = sent.select("partition", "offset", "timestamp", "key", "value", "topic")

    def add(part, parts):
        sent.where(F.col("partition") % parts == part).repartition(2).write.mode("append").parquet(f"{base}/in")

    def publish(change=None):
        options = Options(trigger="available")
        stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
        if change is not None:
            stream = stream.withColumn("value", change)
        return publish_reported(stream, options, f"{base}/checkpoint", f"{base}/report", f"{base}/log")

    return base, add, publish


def test_figures_equal_what_arrived_also_over_a_restart(spark, outbox):
    base, add, publish = outbox
    for part in range(2):
        add(part, 2)
        query, report = publish()
        run(query)
        assert report.close()
        found = read_report(spark, f"{base}/report")
        assert _totals(found) == _arrived(spark.read.parquet(f"{base}/log"))
        assert found.select("batch").distinct().count() == 2 * (part + 1)
    assert found.select("run_id").distinct().count() == 2 and missing(found).count() == 0
    assert {r["topic"] for r in found.collect()} == {*Options().topic_names.values(), None}


def test_a_failure_is_reported_and_its_batch_counted_once(spark, outbox):
    base, add, publish = outbox
    add(0, 1)
    bad = F.when(F.col("offset") >= 0, F.raise_error(F.lit("no such broker"))).cast("binary")
    query, report = publish(bad)
    with pytest.raises(StreamingQueryException):
        run(query)
    assert report.close()
    assert read_report(spark, f"{base}/report").count() == 0
    failures = read_failures(spark, f"{base}/report").collect()
    assert len(failures) == 1 and "no such broker" in failures[0]["error"]
    query, report = publish()
    run(query)
    assert report.close()
    assert _totals(read_report(spark, f"{base}/report")) == _arrived(spark.read.parquet(f"{base}/log"))


def test_gaps_are_seen(spark):
    report = spark.createDataFrame([(0, "a"), (2, "a"), (2, "b"), (5, "a")], "batch bigint, topic string")
    assert sorted(r["batch"] for r in missing(report).collect()) == [1, 3, 4]
    assert missing(report.limit(0)).count() == 0
