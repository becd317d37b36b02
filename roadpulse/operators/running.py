"""Running totals that no single key can turn into one long task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1_000_000


def running_within(
    df: DataFrame,
    keys: Sequence[str],
    index: str,
    sums: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
) -> DataFrame:
    """Running sum or maximum of columns per key, in order of ``index``, current row included.

    ``sums`` and ``maxima`` map output column to input column. For keys known to have few rows.
    """
    so_far = (
        Window.partitionBy(*keys)
        .orderBy(index)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return df.select(
        "*",
        *[F.sum(c).over(so_far).alias(out) for out, c in (sums or {}).items()],
        *[F.max(c).over(so_far).alias(out) for out, c in (maxima or {}).items()],
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    index: str,
    sums: Mapping[str, str] | None = None,
    maxima: Mapping[str, str] | None = None,
    chunk: int = CHUNK,
    chunk_column: str | None = None,
) -> DataFrame:
    """`running_within` for keys of any size.

    ``index`` is an integer that is unique within its key, so a chunk of the index holds at most
    ``chunk`` rows. Rows are shuffled by key *and* chunk, and only one row per chunk is carried
    along the whole key. ``chunk_column`` names a column that already numbers the chunks in order
    of the index; rows partitioned by key and that column are not shuffled again.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    part = chunk_column or "_chunk"
    by_chunk = [*keys, part]
    chunked = df
    if chunk_column is None:
        chunked = df.withColumn(part, F.floor(F.col(index) / F.lit(chunk)).cast("bigint"))

    totals = chunked.groupBy(*by_chunk).agg(
        *[F.sum(c).alias(f"_{out}") for out, c in sums.items()],
        *[F.max(c).alias(f"_{out}") for out, c in maxima.items()],
    )
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *by_chunk,
        *[F.sum(f"_{out}").over(earlier).alias(f"_{out}") for out in sums],
        *[F.max(f"_{out}").over(earlier).alias(f"_{out}") for out in maxima],
    )
    within = running_within(chunked, by_chunk, index, sums, maxima)
    # Rows with a null in the key are a key of their own, as they are to the window.
    renamed = carried.withColumnsRenamed({k: f"_key_{k}" for k in by_chunk})
    same = F.lit(True)
    for k in by_chunk:
        same = same & within[k].eqNullSafe(renamed[f"_key_{k}"])
    joined = within.join(renamed, same, "left")

    def total(out: str) -> Column:
        here, before = F.col(out), F.col(f"_{out}")
        return F.coalesce(here + before, here, before).alias(out)

    return joined.select(
        *df.columns,
        *[total(out) for out in sums],
        *[F.greatest(F.col(out), F.col(f"_{out}")).alias(out) for out in maxima],
    )
