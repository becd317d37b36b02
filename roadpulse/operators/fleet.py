"""Whole-fleet figures: counts, means, shares, detail tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the text an emergency record carries when it reports no incident.
NO_INCIDENT = "None"


def is_incident() -> Column:
    return F.col("type") != NO_INCIDENT


def entries_per_table(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table. Rows of undecodable messages count too."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


def avg_speed(vehicle: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean speed. NaN, which would poison a mean, is left out like null."""
    known = vehicle.where(F.col("speed").isNotNull() & ~F.isnan("speed"))
    return known.groupBy(*by).agg(F.avg("speed").alias("avg_speed"))


def incident_count(emergency: DataFrame) -> DataFrame:
    """All emergency records, and those that report an incident."""
    return emergency.agg(
        F.count("*").alias("n_records"), F.count_if(is_incident()).alias("n_incidents")
    )


def category_share(df: DataFrame, column: str) -> DataFrame:
    """Rows per category and their share of all rows; null is a category of its own.

    The total is a scalar subquery, so no window pulls all categories into one task.
    """
    total = df.agg(F.count("*")).scalar()
    counts = df.groupBy(F.col(column).alias("category")).agg(F.count("*").alias("n_rows"))
    return counts.withColumn("share", F.col("n_rows") / total)


def detail(
    df: DataFrame, where: Column | None, order: Sequence[Column], n: int, tie: str = "id"
) -> DataFrame:
    """The first ``n`` rows in an order; ``tie`` settles equal rows."""
    rows = df if where is None else df.where(where)
    return rows.orderBy(*order, F.col(tie)).limit(n)
