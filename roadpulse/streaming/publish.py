"""Messages sent on as they come: to the broker, or to a log of files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from roadpulse.options import Options
from roadpulse.sources import kafka
from roadpulse.sources.files import side_by_side
from roadpulse.streaming.delivery import DeliveryReport, observed
from roadpulse.streaming.sinks import parquet_writer, with_trigger


def publish(
    messages: DataFrame, options: Options, checkpoint: str, log: str | None = None
) -> StreamingQuery:
    """Start sending a stream of `envelopes`; a restart on the same checkpoint goes on where it ended.

    A log needs the broker's columns (partition, offset, timestamp) among those of the stream.
    """
    if log is None:
        return with_trigger(kafka.stream_publisher(messages, options, checkpoint), options.trigger).start()
    with side_by_side(messages.sparkSession) as written:
        writer = parquet_writer(messages, log, checkpoint, options.trigger).options(**written)
        return writer.partitionBy("topic").start()


def publish_reported(
    messages: DataFrame, options: Options, checkpoint: str, report: str, log: str | None = None
) -> tuple[StreamingQuery, DeliveryReport]:
    """`publish`, with a table of what was delivered under ``report``. Close the report after the query."""
    spark = messages.sparkSession
    listener = DeliveryReport(spark, report, options)
    spark.streams.addListener(listener)
    query = publish(observed(messages, options), options, checkpoint, log)
    listener.follow(query)
    return query, listener
