"""GPS rows with the location of their step, kept as a table by a stream.

`live.gps_position_stream` holds three states: the ids of both sides and the rows of the join. Here the rows that arrived
are the only state, a part for each micro-batch, which does for both. A batch is joined as tables are: the planner knows
their sizes, and adaptive execution splits a step that has very many rows, without salts chosen beforehand.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from roadpulse.schemas import EVENT_TIME, GPS, STEP_KEY, VEHICLE
from roadpulse.sources.files import remove
from roadpulse.streaming.batches import BATCH, read_batch, read_batches, write_batch
from roadpulse.streaming.sinks import with_trigger

LOCATION = "location"
SIDE = "side"


def _both(gps: DataFrame, vehicle: DataFrame) -> DataFrame:
    """Rows that can be joined, of both streams, with the side they are of."""
    places = vehicle.where(F.col(LOCATION).isNotNull()).select("id", *STEP_KEY, LOCATION)
    rows = gps.withColumn(SIDE, F.lit(GPS)).unionByName(
        places.withColumn(SIDE, F.lit(VEHICLE)), allowMissingColumns=True
    )
    return rows.dropna(subset=list(STEP_KEY))


def _ended(latest: list, delay: str, spark: SparkSession) -> datetime | None:
    """The watermark: the time that both sides have passed by more than the delay."""
    times = {}
    for row in latest:
        times[row[SIDE]] = max(times.get(row[SIDE], row["latest"]), row["latest"])
    if len(times) < 2:
        return None
    return spark.sql(f"SELECT :time - INTERVAL {delay} AS ended", args={"time": min(times.values())}).first()["ended"]


def meetings(arrived: DataFrame, columns: list[str], number: int) -> DataFrame:
    """GPS rows with a location of their step, where at least one of both is of the given batch."""
    new = F.col(BATCH) == number
    left = arrived.where(F.col(SIDE) == GPS).select(*columns, new.alias("new_row"))
    right = arrived.where(F.col(SIDE) == VEHICLE).select(*STEP_KEY, F.col(LOCATION).alias("place"), new.alias("new_place"))
    met = left.join(right, list(STEP_KEY)).where("new_row or new_place")
    return met.select(*columns, F.col("place").alias(LOCATION))


def land_positions(
    gps: DataFrame, vehicle: DataFrame, base: str, delay: str = "2 minutes", trigger: str | None = None
) -> StreamingQuery:
    """Start landing gps rows under ``base`` with the location of their step, each as soon as both have arrived.

    Takes both streams before their watermark is declared. Repeats of an id are dropped on both sides, rows without one
    all stay; where a step has several vehicle records, a gps row meets each of them. Rows behind the watermark are left
    out, and a part that lies behind it as a whole is removed. A batch that comes again replaces what it wrote.
    """
    spark, rows = gps.sparkSession, _both(gps, vehicle)
    schema = StructType([StructField(f.name, f.dataType) for f in rows.schema.fields])
    numbered = StructType([*schema.fields, StructField(BATCH, LongType())])

    def write(batch: DataFrame, number: int) -> None:
        earlier = read_batches(spark, f"{base}/arrived", numbered, before=number)
        # Two rows for each part that is still open.
        latest = earlier.groupBy(BATCH, SIDE).agg(F.max(EVENT_TIME).alias("latest")).collect()
        ended = _ended(latest, delay, spark)
        if ended is not None:
            batch, earlier = (df.where(F.col(EVENT_TIME) >= F.lit(ended)) for df in (batch, earlier))
        # A row without an id is its own only copy; so one pass does for all.
        own = F.when(F.col("id").isNull(), F.monotonically_increasing_id())
        single = batch.withColumn("own_name", own).dropDuplicates([SIDE, "id", "own_name"]).drop("own_name")
        if latest:
            single = single.join(earlier.select(SIDE, "id"), [SIDE, "id"], "left_anti")
        write_batch(single, f"{base}/arrived", number)

        new = read_batch(spark, f"{base}/arrived", number, schema).withColumn(BATCH, F.lit(number))
        write_batch(meetings(earlier.unionByName(new), gps.columns, number), f"{base}/data", number)

        open_parts = {row[BATCH] for row in latest if ended is None or row["latest"] >= ended}
        for part in {row[BATCH] for row in latest} - open_parts:
            remove(spark, f"{base}/arrived/{BATCH}={part}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
    return with_trigger(writer, trigger).start()


def read_positions(spark: SparkSession, gps: DataFrame, vehicle: DataFrame, base: str) -> DataFrame:
    """What `land_positions` has landed of such rows."""
    place = StructField(LOCATION, vehicle.schema[LOCATION].dataType)
    return read_batches(spark, f"{base}/data", StructType([*gps.schema.fields, place]))
