"""A table in which a record stands once, however long after it its copies arrive.

A watermark forgets a record's key after its delay. Here nothing is forgotten: each date of the table has a Bloom filter
of the keys landed on it, some three bytes a key. A micro-batch asks the filters which dates may hold one of its keys,
and only those dates are read, their keys only, for an exact answer; a filter that errs costs a look and no row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructField, StructType

from roadpulse.operators.quality import known
from roadpulse.schemas import EVENT_TIME
from roadpulse.sources.files import remove
from roadpulse.streaming.batches import BATCH, read_batch, read_batches, whole_batches, write_batch
from roadpulse.streaming.sinks import with_trigger

#: The date a row is landed under, that of its event time; rows without one have a folder of their own.
DAY = "event_day"

#: A filter is cut into blocks of four words, and a key sets two bits in each word of its block. At ten keys a block
#: (26 bits a key) a filter says maybe to 1 in 10,000 keys that it does not hold.
WORDS, KEYS_PER_BLOCK = 4, 10
_WORDS = [f"word{i}" for i in range(WORDS)]
_FILTER = StructType([StructField(DAY, DateType()), *(StructField(c, LongType()) for c in ("block", *_WORDS))])


def _marks(keys: Sequence[str], blocks: int) -> list[Column]:
    """Block of a row's key, and the bits it sets in the words of that block."""
    bits = F.xxhash64(F.lit("bits"), *keys)

    def bit(turn: int) -> Column:
        place = F.shiftrightunsigned(bits, 6 * turn).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", F.lit(1).cast("long"), place)

    words = [bit(2 * i).bitwiseOR(bit(2 * i + 1)).alias(w) for i, w in enumerate(_WORDS)]
    return [F.pmod(F.xxhash64(*keys), F.lit(blocks)).alias("block"), *words]


def _merged(filters: DataFrame) -> DataFrame:
    return filters.groupBy(DAY, "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS])


class _Filters:
    """The filters under a folder: a part for each batch, put together every ``fold`` batches."""

    def __init__(self, spark: SparkSession, base: str, fold: int):
        self.spark, self.parts, self.folded, self.fold = spark, f"{base}/filters", f"{base}/folded", fold

    def ahead_of(self, number: int) -> DataFrame:
        """All that was landed before a batch. A key's bits stand in one row, that of the batch it came with, or
        in what that became a part of."""
        last = max((n for n in whole_batches(self.spark, self.folded) if n < number), default=-1)
        parts = read_batches(self.spark, self.parts, _FILTER, last, number)
        return read_batch(self.spark, self.folded, last, _FILTER).unionByName(parts)

    def add(self, landed: DataFrame, keys: Sequence[str], blocks: int, number: int) -> None:
        write_batch(_merged(landed.select(DAY, *_marks(keys, blocks))), self.parts, number)
        if (number + 1) % self.fold == 0:
            write_batch(_merged(self.ahead_of(number + 1)), self.folded, number)
            # What the fold before this one holds; that one is still needed if this batch comes again.
            before = number - self.fold
            for n in range(before - self.fold + 1, before + 1):
                remove(self.spark, f"{self.parts}/{BATCH}={n}")
            remove(self.spark, f"{self.folded}/{BATCH}={before - self.fold}")


def land_once(
    decoded: DataFrame,
    base: str,
    keys: Sequence[str] = ("id",),
    keys_a_day: int = 10_000_000,
    fold: int = 16,
    trigger: str | None = None,
) -> StreamingQuery:
    """Start landing rows under ``base`` by the date of their event time, without those whose key is there already.

    Of a key's copies the one of the earliest micro-batch stays; of those in one micro-batch, any one. Rows with a null
    key cannot be told apart and all stay. A batch that comes again replaces what it wrote and looks only at the batches
    before it. ``keys_a_day`` sizes the filters and is for good: dates with more keys are right too, but looked at
    more often.
    """
    spark, keys = decoded.sparkSession, list(keys)
    schema = _with_day(decoded)
    blocks = math.ceil(keys_a_day / KEYS_PER_BLOCK)
    filters = _Filters(spark, base, fold)

    def seen(named: DataFrame, number: int) -> DataFrame | None:
        """Keys of a batch that the table has."""
        asked = named.select(*keys, *_marks(keys, blocks)).withColumnsRenamed({w: f"own_{w}" for w in _WORDS})
        held = F.lit(True)
        for w in _WORDS:
            held = held & (F.col(w).bitwiseAND(F.col(f"own_{w}")) == F.col(f"own_{w}"))
        maybe = asked.join(filters.ahead_of(number), "block").where(held).select(F.col(DAY).alias("day"), *keys)
        write_batch(maybe, f"{base}/asked", number)
        remove(spark, f"{base}/asked/{BATCH}={number - 1}")
        wanted = StructType([StructField("day", DateType()), *(schema[k] for k in keys)])
        maybe = read_batch(spark, f"{base}/asked", number, wanted)
        # As many as the table has dates, at most.
        days = [row["day"] for row in maybe.select("day").distinct().collect()]
        if not days:
            return None
        somewhere = F.col(DAY).isin([d for d in days if d is not None])
        if None in days:
            somewhere = somewhere | F.col(DAY).isNull()
        there = read_batches(spark, f"{base}/data", schema, before=number).where(somewhere).select(DAY, *keys)
        same = F.col(DAY).eqNullSafe(F.col("day"))
        for k in keys:
            same = same & (there[k] == maybe[k])
        return there.join(maybe, same, "left_semi").select(*keys)

    def write(batch: DataFrame, number: int) -> None:
        # Read for its keys and for its rows.
        rows = batch.withColumn(DAY, F.to_date(EVENT_TIME)).persist()
        try:
            single = rows.where(known(keys)).dropDuplicates(keys)
            there = seen(single, number)
            new = single if there is None else single.join(there, keys, "left_anti")
            write_batch(new.unionByName(rows.where(~known(keys))), f"{base}/data", number, [DAY])
        finally:
            rows.unpersist()
        landed = read_batch(spark, f"{base}/data", number, schema).where(known(keys))
        filters.add(landed, keys, blocks, number)

    writer = decoded.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
    return with_trigger(writer, trigger).start()


def _with_day(decoded: DataFrame) -> StructType:
    return StructType([*decoded.schema.fields, StructField(DAY, DateType())])


def read_once(spark: SparkSession, decoded: DataFrame, base: str) -> DataFrame:
    """What `land_once` has landed of such rows."""
    return read_batches(spark, f"{base}/data", _with_day(decoded)).drop(DAY)
