"""The message broker as a source and a sink. The connector is a package given at submit time."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql.streaming.readwriter import DataStreamWriter

from roadpulse.options import Options
from roadpulse.schemas import get_schema


def source_options(options: Options, topic: str) -> dict[str, str]:
    get_schema(topic)
    result = {
        "kafka.bootstrap.servers": options.servers,
        "subscribe": options.topic_name(topic),
        "startingOffsets": options.starting_offsets,
    }
    if options.min_partitions is not None:
        result["minPartitions"] = str(options.min_partitions)
    if options.max_offsets_per_trigger is not None:
        result["maxOffsetsPerTrigger"] = str(options.max_offsets_per_trigger)
    return result


def sink_options(options: Options) -> dict[str, str]:
    return {"kafka.bootstrap.servers": options.servers}


def read_topic(spark: SparkSession, topic: str, options: Options) -> DataFrame:
    """Stream of one topic's messages. A checkpoint, once there, overrides the start position."""
    return spark.readStream.format("kafka").options(**source_options(options, topic)).load()


def publisher(messages: DataFrame, options: Options) -> DataFrameWriter:
    """Writer of ``key, value, topic`` rows. ``save()`` returns after delivery and fails the job
    if a message cannot be delivered."""
    return messages.write.format("kafka").options(**sink_options(options))


def stream_publisher(
    messages: DataFrame, options: Options, checkpoint: str
) -> DataStreamWriter:
    return (
        messages.writeStream.format("kafka")
        .options(**sink_options(options))
        .option("checkpointLocation", checkpoint)
    )
