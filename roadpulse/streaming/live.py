"""Streaming counterparts of the table analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.operators.decode import decode_checked
from roadpulse.schemas import EVENT_TIME, STEP_KEY


def quarantine(messages: DataFrame, topic: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    """Sound rows, and the messages that are not, with their text. Two streams for two sinks."""
    checked = decode_checked(messages, topic, *keep)
    sound = checked.where(F.col("problem").isNull()).drop("value", "problem", *keep)
    unsound = checked.where(F.col("problem").isNotNull()).select(*keep, "value", "problem")
    return sound, unsound


def _once(decoded: DataFrame, delay: str) -> DataFrame:
    """Rows without repeats of an id; a row without one gets a name of its own and stays."""
    named = decoded.withColumn("_name", F.coalesce("id", F.uuid()))
    return named.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark(["_name"]).drop("_name")


def gps_position_stream(
    gps: DataFrame, vehicle: DataFrame, delay: str = "2 minutes", salts: int = 4
) -> DataFrame:
    """GPS rows with the location of their step, live.

    Takes both streams before their watermark is declared. Repeats are dropped on both sides by
    id; where a step has several vehicle records, a gps row meets each of them, as in the batch
    join of `places.gps_density`. The rows of a much-used step are spread over ``salts`` tasks. As
    event time is part of the join key, state is dropped when the watermark passes.
    """
    # Rows without an id are dealt out by their place, the same if a task is run again.
    by_id = F.pmod(F.xxhash64("id"), F.lit(salts))
    salt = F.when(F.col("id").isNotNull(), by_id).otherwise(F.floor(F.rand(salts) * salts)).cast("int")
    left = _once(gps, delay).withColumn("_salt", salt)
    places = vehicle.where(F.col("location").isNotNull()).select("id", *STEP_KEY, "location")
    right = _once(places, delay).drop("id").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    return left.join(right, [*STEP_KEY, "_salt"], "inner").drop("_salt")
