"""Checks on decoded rows: repeats, lateness, ranges."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.running import CHUNK, running
from roadpulse.schemas import EVENT_TIME, GPS, VEHICLE, WEATHER

# The range each field is produced in, both ends included.
RANGES = {
    VEHICLE: {"speed": (10.0, 40.0)},
    GPS: {"speed": (0.0, 40.0)},
    WEATHER: {
        "temperature": (-5.0, 26.0),
        "precipitation": (0.0, 25.0),
        "windSpeed": (0.0, 100.0),
        "humidity": (0.0, 100.0),
        "airQualityIndex": (0.0, 500.0),
    },
}


def _first_of_each(keys: Sequence[str]):
    names = list(keys)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array(np.arange(batch.num_rows))
            keyed = pa.table([batch.column(n) for n in names] + [rows], names=[*names, "_row"])
            first = keyed.group_by(names).aggregate([("_row", "min")])["_row_min"]
            yield batch.take(first.combine_chunks())

    return reduce


def known(keys: Sequence[str]) -> Column:
    """Whether no key is null."""
    every = F.lit(True)
    for key in keys:
        every = every & F.col(key).isNotNull()
    return every


def drop_repeats_stream(
    decoded: DataFrame, keys: Sequence[str] = ("id",), delay: str = "2 minutes", thin: bool = False
) -> DataFrame:
    """Stream of decoded rows without the repeats that arrive within the watermark delay.

    Takes the stream *before* its watermark is declared. Rows with a null key cannot be told apart
    and all pass, beside the state. ``thin`` drops rows equal in key and event time inside each
    Arrow batch first, so that one much-repeated record does not travel to a single task whole; it
    sends every row through Python, so it is for streams that have such records.
    """
    keyed = decoded.where(known(keys))
    if thin:
        keyed = keyed.mapInArrow(_first_of_each([*keys, EVENT_TIME]), keyed.schema)
    single = keyed.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark(list(keys))
    # No watermark on the rest: with hardly a row, it would hold back that of the whole query.
    return single.unionByName(decoded.where(~known(keys)))


def drop_repeats(table: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Landed table without repeats. Rows with a null key are all kept."""
    single = table.where(known(keys)).dropDuplicates(list(keys))
    return single.unionByName(table.where(~known(keys)))


ORIGIN_KEY = ("source_topic", "source_partition")


def late_rows(
    decoded: DataFrame, delay: str = "2 minutes", chunk: int = CHUNK, before: DataFrame | None = None
) -> DataFrame:
    """Rows decoded with their origin, labelled ``late`` where the event time is behind the latest
    one seen so far on the same topic partition by more than ``delay``.

    ``before`` has the latest time ``seen`` ahead of these rows, one row per topic partition.
    """
    seen = running(decoded, ORIGIN_KEY, "source_offset", maxima={"_seen": EVENT_TIME}, chunk=chunk)
    if before is not None:
        earlier = before.toDF("_topic", "_partition", "_before")
        same = F.col("source_topic").eqNullSafe(F.col("_topic")) & F.col("source_partition").eqNullSafe(F.col("_partition"))
        seen = seen.join(earlier, same, "left").withColumn("_seen", F.greatest("_seen", "_before"))
    late = F.col(EVENT_TIME) < F.col("_seen") - F.expr(f"INTERVAL {delay}")
    return seen.select(*decoded.columns, F.coalesce(late, F.lit(False)).alias("late"))


def range_violations(
    tables: Mapping[str, DataFrame], ranges: Mapping[str, Mapping[str, tuple]] = RANGES
) -> DataFrame:
    """Rows below and above each field's range: one pass per table."""
    parts = []
    for topic, fields in ranges.items():
        counts = tables[topic].agg(
            *[F.count_if(F.col(f) < low).alias(f"{f}_below") for f, (low, _) in fields.items()],
            *[F.count_if(F.col(f) > high).alias(f"{f}_above") for f, (_, high) in fields.items()],
        )
        rows = [
            F.struct(
                F.lit(topic).alias("topic"),
                F.lit(f).alias("field"),
                F.col(f"{f}_below").alias("n_below"),
                F.col(f"{f}_above").alias("n_above"),
            )
            for f in fields
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
