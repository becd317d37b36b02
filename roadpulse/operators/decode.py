"""Message payload to typed columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from roadpulse.schemas import EVENT_TIME, get_schema

CORRUPT = "_corrupt_record"
ORIGIN = {
    "topic": "source_topic",
    "partition": "source_partition",
    "offset": "source_offset",
    "timestamp": "source_time",
}


def payload() -> Column:
    return F.col("value").cast("string")


def _fields(data: Column) -> Column:
    """The fields of a decoded struct as columns, nulls where there is no struct.

    Like selecting ``data.*``, but through a generator: a filter on a field of a projection is
    pushed below it and decodes the message again, once for every field it names.
    """
    return F.inline(F.array(data))


def decode(
    messages: DataFrame,
    topic: str,
    columns: Sequence[str] | None = None,
    keep_origin: bool = False,
) -> DataFrame:
    """Decode ``value`` against the topic's schema, permissively, and flatten it.

    No message is dropped: one that cannot be decoded becomes a row of nulls. ``columns`` decodes
    only these. ``keep_origin`` adds topic, partition, offset and broker time, which are otherwise
    left behind.
    """
    schema = get_schema(topic)
    if columns is not None:
        schema = StructType([schema[c] for c in columns])
    kept = [F.col(c).alias(alias) for c, alias in ORIGIN.items()] if keep_origin else []
    return messages.select(_fields(F.from_json(payload(), schema)), *kept)


def decode_checked(
    messages: DataFrame, topic: str, *keep: str, keys: Sequence[str] = ("id",)
) -> DataFrame:
    """Decode, and say of each message whether it is sound.

    Adds ``value`` (the text) and ``problem``: null for a sound message, ``empty`` where there was
    no text, ``malformed`` where the text is not one JSON object or a field did not fit the schema,
    ``keyless`` where one of ``keys`` is missing.
    """
    declared = get_schema(topic)
    schema = StructType([*declared.fields, StructField(CORRUPT, StringType())])
    text = messages.select(payload().alias("value"), *keep)
    # An explicit option keeps the optimizer from narrowing the schema to the fields in use, which
    # would leave errors in the other fields unseen.
    data = F.from_json("value", schema, {"columnNameOfCorruptRecord": CORRUPT})
    rows = text.select("value", *keep, _fields(data))
    # A parser stops after the first value; as an array the whole text has to be one.
    listed = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), "array<struct<id:string>>")
    alone = F.coalesce(F.size(listed) == 1, F.lit(False))
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    problem = (
        F.when(F.col("value").isNull() | F.col("value").rlike(r"^\s*$"), "empty")
        .when(F.col(CORRUPT).isNotNull() | F.col("value").rlike(r"^\s*null\s*$") | ~alone, "malformed")
        .when(missing, "keyless")
    )
    return rows.withColumn("problem", problem).drop(CORRUPT)


def with_event_time(df: DataFrame, delay: str = "2 minutes") -> DataFrame:
    """Declare event time. On its own this drops nothing; stateful operators act on it."""
    return df.withWatermark(EVENT_TIME, delay)
