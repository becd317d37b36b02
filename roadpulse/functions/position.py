"""Positions: location text, grid cells, the arrival test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# End points of the journey, in degrees.
START_LATITUDE, START_LONGITUDE = 51.5074, -0.1278
END_LATITUDE, END_LONGITUDE = 52.4862, -1.8904


def location_array(lat: Column, lon: Column) -> Column:
    """Location as a producer sends it: a two-number array, latitude first."""
    return F.array(lat, lon)


def with_position(df: DataFrame, column: str = "location") -> DataFrame:
    """Add ``lat`` and ``lon`` parsed from the text of a two-number array.

    Text that is no array gives nulls; an element that is missing is null. The pair comes out of
    a generator rather than a projection, because a filter on ``lat`` or ``lon`` would otherwise
    be pushed below the projection and parse the text again.
    """
    pair = F.col("_pair")
    parsed = df.withColumn("_pair", F.from_json(F.col(column), "array<double>"))
    point = F.struct(F.get(pair, F.lit(0)).alias("lat"), F.get(pair, F.lit(1)).alias("lon"))
    return parsed.select("*", F.inline(F.array(point))).drop("_pair")


def has_position() -> Column:
    return F.col("lat").isNotNull() & F.col("lon").isNotNull()


def has_arrived(lat: Column, lon: Column) -> Column:
    """North of and west of the destination, both inclusive."""
    return (lat >= END_LATITUDE) & (lon <= END_LONGITUDE)


def cell(degrees: Column, size: float) -> Column:
    """Index of the grid cell that holds a coordinate."""
    return F.floor(degrees / F.lit(size)).cast("bigint")
