"""Measures over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.fleet import is_incident
from roadpulse.schemas import EVENT_TIME

WIDTH = "1 hour"


def _mean(column: str) -> Column:
    known = F.when(~F.isnan(column), F.col(column))
    return F.avg(known).alias(f"avg_{column}")


def vehicle_measures() -> list[Column]:
    return [F.count("*").alias("n_records"), _mean("speed")]


def weather_measures() -> list[Column]:
    return [
        F.count("*").alias("n_records"),
        _mean("temperature"),
        _mean("precipitation"),
        _mean("windSpeed"),
        F.avg("humidity").alias("avg_humidity"),
        _mean("airQualityIndex"),
    ]


def emergency_measures() -> list[Column]:
    return [
        F.count("*").alias("n_records"),
        F.count_if(is_incident()).alias("n_incidents"),
    ]


def series(df: DataFrame, measures: Sequence[Column], width: str = WIDTH) -> DataFrame:
    """Measures per time bucket, aligned to the epoch; empty buckets are absent.

    The same call serves a stream: with a watermark and append output a bucket appears once the
    watermark has passed its end.
    """
    buckets = df.groupBy(F.window(EVENT_TIME, width).alias("bucket")).agg(*measures)
    names = [c for c in buckets.columns if c != "bucket"]
    return buckets.select(F.col("bucket.start").alias("bucket_start"), *names)
