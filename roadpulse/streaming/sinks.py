"""Streams to checkpointed Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from roadpulse.options import Options
from roadpulse.schemas import DATE_COLUMN, EVENT_TIME


def with_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    if trigger is None:
        return writer
    if trigger == "available":
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def parquet_writer(
    df: DataFrame, path: str, checkpoint: str, trigger: str | None = None, name: str | None = None
) -> DataStreamWriter:
    """Append a stream to a folder. The checkpoint makes a rerun go on where the last one ended,
    with each row written once."""
    writer = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    if name is not None:
        writer = writer.queryName(name)
    return with_trigger(writer, trigger)


def land(df: DataFrame, topic: str, options: Options) -> StreamingQuery:
    """Start landing one topic: a data folder and a checkpoint folder of its own."""
    if options.partition_by_date:
        df = df.withColumn(DATE_COLUMN, F.to_date(EVENT_TIME))
    writer = parquet_writer(
        df, options.data_path(topic), options.checkpoint_path(topic), options.trigger, topic
    )
    if options.partition_by_date:
        writer = writer.partitionBy(DATE_COLUMN)
    return writer.start()
