"""Journey steps to records, records to keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

from roadpulse.functions.position import location_array
from roadpulse.options import Options
from roadpulse.schemas import TOPICS, get_schema

# All digits of an event time; the writer's own default stops at milliseconds.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

_ENCODABLE = (
    StringType, BooleanType, IntegerType, LongType, FloatType, DoubleType, TimestampType,
)

_SHARED = ("vehicle_id", "timestamp")


def record_columns(topic: str) -> list[Column]:
    """A topic's record, in schema order, from a step.

    A step has the shared columns ``vehicle_id, timestamp, lat, lon`` and, for each topic, a
    struct of that name with what only this record kind has.
    """
    columns = []
    for name in get_schema(topic).fieldNames():
        if name == "location":
            columns.append(location_array(F.col("lat"), F.col("lon")).alias(name))
        elif name in _SHARED:
            columns.append(F.col(name))
        else:
            columns.append(F.col(f"{topic}.{name}").alias(name))
    return columns


def records(steps: DataFrame, topic: str) -> DataFrame:
    """One of the five projections of a step."""
    return steps.select(*record_columns(topic))


def fan_out(steps: DataFrame) -> dict[str, DataFrame]:
    """All five projections; they share step key and position."""
    return {topic: records(steps, topic) for topic in TOPICS}


def check_encodable(schema: StructType) -> None:
    """A type without a JSON form is an error, not something to render somehow."""

    def check(name: str, kind: DataType) -> None:
        if isinstance(kind, ArrayType):
            check(name, kind.elementType)
        elif isinstance(kind, StructType):
            for f in kind.fields:
                check(f"{name}.{f.name}", f.dataType)
        elif not isinstance(kind, _ENCODABLE):
            raise TypeError(f"column {name} of type {kind.simpleString()} is not JSON serializable")

    for f in schema.fields:
        check(f.name, f.dataType)


def _own(steps: DataFrame, topic: str) -> list[str]:
    return steps.schema[topic].dataType.fieldNames()


def json_of(*columns: Column) -> Column:
    return F.to_json(F.struct(*columns), {"timestampFormat": TIME_FORMAT})


def encode(df: DataFrame, topic: str, key: str = "id") -> DataFrame:
    """Records of one topic as ``key, value, topic``, the columns a message sink takes.

    The key is the record's id; ``vehicle_id`` keeps a vehicle's records in order on one partition
    instead, at the price of a hot partition for a busy vehicle.
    """
    check_encodable(df.schema)
    return df.select(
        F.col(key).cast("binary").alias("key"),
        json_of(*[F.col(c) for c in df.columns]).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
    )


def envelopes(
    steps: DataFrame, *keep: str, options: Options | None = None, key: str = "id"
) -> DataFrame:
    """All five messages of every step in a single pass over the steps.

    ``keep`` names further step columns to carry along; ``options`` may rename the topics. ``key``
    is a field of the records or a column of the steps, see `encode`.
    """
    options = options or Options()
    messages = []
    for topic in TOPICS:
        check_encodable(records(steps, topic).schema)
        messages.append(
            F.struct(
                F.col(f"{topic}.{key}" if key in _own(steps, topic) else key)
                .cast("binary")
                .alias("key"),
                json_of(*record_columns(topic)).cast("binary").alias("value"),
                F.lit(options.topic_name(topic)).alias("topic"),
            )
        )
    return steps.select(*keep, F.inline(F.array(*messages)))
