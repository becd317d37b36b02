"""What was delivered: messages, bytes and missing keys of every micro-batch and topic, and failures, as a table.

The figures are observed while a batch is sent, so they cost no second pass, and are reported once the sink has
confirmed all of it. A batch keeps its number over restarts and its row is replaced, never added to.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from roadpulse.options import Options
from roadpulse.streaming.batches import read_batches, write_batch

METRICS = "delivery"
_ROWS = "topic STRING, messages BIGINT, keyless BIGINT, empty BIGINT, bytes BIGINT, run_id STRING"
_FAILURES = "run_id STRING, error STRING"
_FIGURES = ("messages", "keyless", "empty", "bytes")


def observed(messages: DataFrame, options: Options) -> DataFrame:
    """The messages, with figures by topic observed as they pass. Topics the options do not name count together,
    under null."""
    metrics = []
    names = list(options.topic_names.values())
    for n, name in enumerate([*names, None]):
        here = F.col("topic") == name if name is not None else ~F.coalesce(F.col("topic").isin(names), F.lit(False))
        size = F.coalesce(F.sum(F.when(here, F.octet_length("value"))), F.lit(0))
        metrics += [
            F.count_if(here).alias(f"messages_{n}"),
            F.count_if(here & F.col("key").isNull()).alias(f"keyless_{n}"),
            F.count_if(here & F.col("value").isNull()).alias(f"empty_{n}"),
            size.alias(f"bytes_{n}"),
        ]
    return messages.observe(METRICS, *metrics)


class DeliveryReport(StreamingQueryListener):
    """Writes the report of one query of `observed` messages under ``path``.

    Batches appear in the report after they are delivered. Should the driver die between the two, a batch is
    missing from it: numbers are gapless otherwise, see `missing`.
    """

    def __init__(self, spark: SparkSession, path: str, options: Options):
        self.spark, self.path = spark, path
        self.topics = [*options.topic_names.values(), None]
        self.run_id: str | None = None
        self.ended = threading.Event()

    def follow(self, query: StreamingQuery) -> None:
        """Report on this query; its events are kept back until it is known which one it is."""
        self.run_id = str(query.runId)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        figures = progress.observedMetrics.get(METRICS)
        if str(progress.runId) != self.run_id or figures is None or not progress.numInputRows:
            return
        rows = [
            (topic, *(figures[f"{name}_{n}"] for name in _FIGURES), self.run_id)
            for n, topic in enumerate(self.topics)
            if figures[f"messages_{n}"]
        ]
        write_batch(self.spark.createDataFrame(rows, _ROWS).coalesce(1), f"{self.path}/batches", progress.batchId)

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) != self.run_id:
            return
        if event.exception is not None:
            failure = self.spark.createDataFrame([(self.run_id, str(event.exception))], _FAILURES)
            failure.coalesce(1).write.mode("append").parquet(f"{self.path}/failures")
        self.ended.set()

    def close(self, timeout: float = 60.0) -> bool:
        """Wait until the query's last event is in the report, and listen no more. False if it did not come."""
        complete = self.ended.wait(timeout)
        self.spark.streams.removeListener(self)
        return complete


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """(batch, topic, messages, keyless, empty, bytes, run_id) of all delivered batches."""
    return read_batches(spark, f"{path}/batches", StructType.fromDDL(f"batch BIGINT, {_ROWS}"))


def read_failures(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, error) of the runs that ended in an error."""
    return spark.read.schema(_FAILURES).option("ignoreMissingFiles", True).parquet(f"{path}/failures")


def missing(report: DataFrame) -> DataFrame:
    """Numbers of batches up to the last one that the report does not have."""
    last = report.agg(F.max("batch").alias("last")).where("last is not null")
    numbers = last.select(F.explode(F.sequence(F.lit(0).cast("bigint"), "last")).alias("batch"))
    return numbers.join(report.select("batch").distinct(), "batch", "left_anti")
