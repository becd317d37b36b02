"""The `events` table read as a log of journey steps.

One event is one step of the vehicle its user stands for; each step gives the five records. Steps
run to 120, past the arrival at 100, so that some rows lie beyond it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.operators.encode import json_of, record_columns
from roadpulse.schemas import EMERGENCY, GPS, TRAFFIC, VEHICLE, WEATHER
from roadpulse.sources.files import stream_table

# The rule that derives records from events, shared with the SQL oracles.
STEPS = 121
LATITUDE, LATITUDE_STEP = 51.5074, 0.009788
LONGITUDE, LONGITUDE_STEP = -0.1278, 0.017626

PARTITIONS = 4
_REVERSED = 8


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(events_path(sf_dir))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_table(spark, sf_dir, "events")


def read_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps(read_events(spark, sf_dir))


def stream_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return steps(stream_events(spark, sf_dir))


def events_path(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events.parquet"


def _id(prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col("event_id").cast("string"))


def _pick(number: Column, *values: str) -> Column:
    """values[number], the last one for anything larger."""
    chosen = F.lit(values[-1])
    for i in reversed(range(len(values) - 1)):
        chosen = F.when(number == i, values[i]).otherwise(chosen)
    return chosen


def steps(events: DataFrame) -> DataFrame:
    """Steps with their shared columns, their five attribute structs and a place in a log.

    Arrival order differs from event order: offsets count back within blocks of eight, so a topic
    partition has late rows.
    """
    event, user = F.col("event_id"), F.col("user_id")
    nth = (event % STEPS).cast("double")
    arrival = F.floor(event / PARTITIONS)
    block = F.floor(arrival / _REVERSED) * _REVERSED
    return events.select(
        "event_id",
        F.concat(F.lit("V-"), user.cast("string")).alias("vehicle_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.lit(LATITUDE) + F.lit(LATITUDE_STEP) * nth).alias("lat"),
        (F.lit(LONGITUDE) - F.lit(LONGITUDE_STEP) * nth).alias("lon"),
        (event % PARTITIONS).cast("int").alias("partition"),
        (block + (_REVERSED - 1) - (arrival - block)).cast("bigint").alias("offset"),
        F.struct(
            _id("v").alias("id"),
            (F.lit(10) + event % 31).cast("double").alias("speed"),
            F.lit("North-East").alias("direction"),
            _pick(user % 3, "Make-A", "Make-B", "Make-C").alias("make"),
            F.lit("Model S").alias("model"),
            (F.lit(2020) + user % 5).cast("int").alias("year"),
            _pick(user % 2, "Electric", "Hybrid").alias("fuelType"),
        ).alias(VEHICLE),
        F.struct(
            _id("g").alias("id"),
            (event % 41).cast("double").alias("speed"),
            F.lit("North-East").alias("direction"),
            _pick(user % 4, "public", "private").alias("vehicleType"),
        ).alias(GPS),
        F.struct(
            _id("t").alias("id"),
            F.concat(F.lit("cam-"), (event % 7).cast("string")).alias("camera_id"),
            F.lit("Base64EncodedString").alias("snapshot"),
        ).alias(TRAFFIC),
        F.struct(
            _id("w").alias("id"),
            (event % 32 - 5).cast("double").alias("temperature"),
            _pick(event % 4, "Sunny", "Cloudy", "Rain", "Snow").alias("weatherCondition"),
            (event % 26).cast("double").alias("precipitation"),
            (event % 101).cast("double").alias("windSpeed"),
            (event % 101).cast("int").alias("humidity"),
            F.col("value").alias("airQualityIndex"),
        ).alias(WEATHER),
        F.struct(
            _id("e").alias("id"),
            _id("i").alias("incidentId"),
            _pick(event % 5, "Accident", "Fire", "Medical", "Police", "None").alias("type"),
            _pick(event % 2, "Active", "Resolved").alias("status"),
            F.lit("Description of the incident").alias("description"),
        ).alias(EMERGENCY),
    )


def messages(steps: DataFrame, topic: str, *keep: str) -> DataFrame:
    """One topic's messages with the broker's columns."""
    return steps.select(
        *keep,
        F.col(f"{topic}.id").cast("binary").alias("key"),
        json_of(*record_columns(topic)).cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        "partition",
        "offset",
        "timestamp",
        F.lit(0).alias("timestampType"),
    )


def _with(pattern: str, replacement: str) -> Callable[[Column, Column], Column]:
    return lambda text, _: F.regexp_replace(text, pattern, replacement)


def _text(value: str | None) -> Callable[[Column, Column], Column]:
    return lambda *_: F.lit(value).cast("string")


# Ways a message can differ from its schema: from its whole text and its record's id.
DAMAGE: tuple[tuple[str, Callable[[Column, Column], Column]], ...] = (
    ("complete", lambda text, _: text),
    ("missing field", _with('"speed":[^,]*,', "")),
    ("unknown field", _with(r"^\{", '{"zzz":1,')),
    ("text for number", _with('"speed":([^,]*),', '"speed":"$1",')),
    ("number for text", _with('"id":"[^"]*"', '"id":7')),
    ("not a number", _with('"speed":[^,]*,', '"speed":NaN,')),
    ("bad timestamp", _with('"timestamp":"[^"]*"', '"timestamp":"yesterday"')),
    ("epoch number", _with('"timestamp":"[^"]*"', '"timestamp":1704067200')),
    ("zoned timestamp", _with('"timestamp":"([^"]*)"', '"timestamp":"$1+02:00"')),
    ("wrong case", _with('"id":', '"ID":')),
    ("repeated key", _with(r"^\{", '{"id":"first",')),
    ("object for text", _with('"id":"[^"]*"', '"id":{"a": 1}')),
    ("cut short", lambda text, _: F.substring(text, 1, 40)),
    ("not JSON", lambda _, name: F.concat(F.lit("hello "), name)),
    ("JSON null", _text("null")),
    ("top-level array", lambda text, _: F.concat(F.lit("["), text, F.lit("]"))),
    ("empty text", _text("")),
    ("tombstone", _text(None)),
    ("white space", _text("\n\t ")),
    ("no fields", _text("{}")),
    ("null id", _with('"id":"[^"]*"', '"id":null')),
    ("trailing text", lambda text, _: F.concat(text, F.lit(" trailing"))),
    ("two records", lambda text, _: F.concat(text, text)),
)


def damaged(steps: DataFrame, *keep: str) -> DataFrame:
    """GPS messages, each damaged in the way its event number picks (`DAMAGE`)."""
    case = F.col("event_id") % len(DAMAGE)
    whole, name = json_of(*record_columns(GPS)), F.col(f"{GPS}.id")
    text = F.lit(None).cast("string")
    for number, (_, harm) in enumerate(DAMAGE):
        text = F.when(case == number, harm(whole, name)).otherwise(text)
    return steps.select(
        *keep,
        case.cast("int").alias("damage"),
        text.cast("binary").alias("value"),
        "partition",
        "offset",
    )
