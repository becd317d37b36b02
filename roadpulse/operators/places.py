"""Routes, last positions, point density, arrivals."""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadpulse.functions.position import cell, has_arrived, has_position, with_position
from roadpulse.schemas import STEP_KEY
from roadpulse.session import materialize

CELL_DEGREES = 0.05

_POINT = ("vehicle_id", "timestamp", "id", "lat", "lon")


def points(vehicle: DataFrame) -> DataFrame:
    """Records that place a vehicle: those with a vehicle and a position."""
    placed = with_position(vehicle.where(F.col("vehicle_id").isNotNull()))
    return placed.where(has_position()).select(*_POINT)


#: Rows of a vehicle that one task numbers, about.
RANGE_ROWS = 1_000_000
#: Most ranges that the sketch of a vehicle's times is cut into.
MOST_RANGES = 4096
#: Copies of one record that leave a task together.
COPY_ROWS = 10_000
_BLOCK = 64


def _time_ranges(vehicle: DataFrame, range_rows: int) -> list[tuple[str, list[int], list[list[int]], list[int]]]:
    """Where the times of busy vehicles are cut, in microseconds: (vehicle, first cut of each block, blocks, numbers of
    the ranges that are one instant).

    Only what is counted and sketched comes here: at most a cut for every ``range_rows`` rows.
    """
    spark = vehicle.sparkSession
    known = vehicle.where(F.col("vehicle_id").isNotNull()).select(
        "vehicle_id", F.unix_micros("timestamp").alias("_at")
    )
    counts = known.groupBy("vehicle_id").agg(F.count("*").alias("_n"), F.count("_at").alias("_timed"))
    busy = {r["vehicle_id"]: r for r in counts.where(F.col("_n") > range_rows).collect()}
    if not busy:
        return []
    ranges = min(MOST_RANGES, max(-(-r["_n"] // range_rows) for r in busy.values()))
    grid = [k / ranges for k in range(1, ranges)]
    sizes = spark.createDataFrame([(v, r["_n"]) for v, r in busy.items()], "vehicle_id string, _n bigint")
    step = F.greatest(F.lit(1), F.floor(F.lit(ranges * range_rows) / F.first("_n")))
    sketch = known.join(F.broadcast(sizes), "vehicle_id").groupBy("vehicle_id").agg(
        F.percentile_approx("_at", grid, 8 * ranges).alias("_grid"), step.alias("_step")
    )
    chosen = F.filter("_grid", lambda _, i: (i + 1) % F.col("_step") == 0)
    found = []
    for row in sketch.select("vehicle_id", chosen.alias("cuts")).collect():
        cuts = row["cuts"] or []
        # An instant that takes more than one cut makes a range of its own.
        instants = sorted({a for a, b in zip(cuts, cuts[1:]) if a == b})
        cuts = sorted({*cuts, *instants, *(t + 1 for t in instants)})
        single = [bisect_right(cuts, t) for t in instants]
        of = busy[row["vehicle_id"]]
        if of["_n"] - of["_timed"] > range_rows:
            single.append(-1)
        blocks = [cuts[k : k + _BLOCK] for k in range(0, len(cuts), _BLOCK)]
        found.append((row["vehicle_id"], [block[0] for block in blocks], blocks, single))
    return found


def in_ranges(vehicle: DataFrame, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, bool]:
    """Points with ``_range``, the number of the stretch of time that they are in, and ``_single``, whether that is one
    instant; and whether any is. Ranges of a vehicle are in order of time; rows without time come first."""
    found = _time_ranges(vehicle, range_rows)
    placed = points(vehicle)
    if not found:
        return placed.withColumns({"_range": F.lit(0), "_single": F.lit(False)}), False
    cuts = vehicle.sparkSession.createDataFrame(
        found, "vehicle_id string, _first array<bigint>, _blocks array<array<bigint>>, _alone array<int>"
    )
    at = F.unix_micros("timestamp")
    block = F.size(F.filter("_first", lambda c: c <= at))
    inside = F.size(F.filter(F.get("_blocks", block - 1), lambda c: c <= at))
    number = (
        F.when(F.col("_first").isNull(), 0)
        .when(at.isNull(), -1)
        .when(block == 0, 0)
        .otherwise((block - 1) * _BLOCK + inside)
    )
    ranged = (
        placed.join(F.broadcast(cuts), "vehicle_id", "left")
        .withColumn("_range", number.cast("int"))
        .withColumn("_single", F.coalesce(F.array_contains("_alone", F.col("_range")), F.lit(False)))
    )
    return ranged.select(*_POINT, "_range", "_single"), any(single for *_, single in found)


def routes(vehicle: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each vehicle's points numbered from 1 in order of time, then id.

    A vehicle is not confined to one task, whatever its share of the rows. Vehicles of more than ``range_rows`` rows are
    cut into ranges of time by a quantile sketch, and points are shuffled by vehicle and range. A point's number is its
    place in the range, plus the vehicle's points in earlier ranges, of which one count per range is carried. An
    instant that fills a range by itself holds copies: these are counted, numbered as so many, and told apart only after
    that, over many tasks. Different ids of one vehicle and instant stay together.

    Counting and sketching run when this is called; nothing is written.
    """
    ranged, instants = in_ranges(vehicle, range_rows)
    key = ["vehicle_id", "_range"]
    order = ("timestamp", "id", "lat", "lon")
    plain = ranged.where(~F.col("_single")) if instants else ranged
    numbered = plain.withColumn("seq", F.row_number().over(Window.partitionBy(*key).orderBy(*order)).cast("bigint"))
    if instants:
        numbered = numbered.select(*key, "seq", *order).unionByName(_numbered_copies(ranged, key, order))
    # Only busy vehicles have earlier ranges.
    earlier = Window.partitionBy("vehicle_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        ranged.groupBy(*key)
        .agg(F.count("*").alias("_n"))
        .select(*key, F.sum("_n").over(earlier).alias("_before"))
        .where(F.col("_before") > 0)
    )
    return numbered.join(before, key, "left").select(
        "vehicle_id", (F.col("seq") + F.coalesce("_before", F.lit(0))).alias("seq"), "timestamp", "id", "lat", "lon"
    )


def _numbered_copies(ranged: DataFrame, key: list[str], order: tuple[str, ...]) -> DataFrame:
    """Points of single instants numbered within their range: copies are one row until they have their numbers."""
    copies = ranged.where("_single").groupBy(*key, *order).agg(F.count("*").alias("_copies"))
    parts = copies.withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPY_ROWS))))
    many = F.least(F.lit(COPY_ROWS), F.col("_copies") - F.col("_part") * COPY_ROWS)
    so_far = Window.partitionBy(*key).orderBy(*order, "_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn("_many", many).withColumn("_ahead", F.coalesce(F.sum("_many").over(so_far), F.lit(0)))
    spread = placed.repartition("vehicle_id", "_range", "_ahead")
    each = F.explode(F.sequence(F.lit(1), F.col("_many")))
    return spread.select(*key, "_ahead", *order, each.alias("_nth")).select(
        *key, (F.col("_ahead") + F.col("_nth")).alias("seq"), *order
    )


def latest_position(vehicle: DataFrame) -> DataFrame:
    """Last known position per vehicle, of equal times that of the greatest id; records without a time cannot be last.

    One scan, each position parsed once. Taking the greatest row sorts within each task before the shuffle; on 12 million
    rows that took two thirds of the time of a hash aggregate of the times that is joined back.
    """
    known = points(vehicle).where(F.col("timestamp").isNotNull())
    last = known.groupBy("vehicle_id").agg(F.max(F.struct("timestamp", "id", "lat", "lon")).alias("last"))
    return last.select("vehicle_id", "last.timestamp", "last.lat", "last.lon")


def gps_density(gps: DataFrame, vehicle: DataFrame, size: float = CELL_DEGREES) -> DataFrame:
    """GPS points per grid cell. The position of a point is that of its step's vehicle record.

    Both sides are counted per step before the join, and the counts multiplied: the figure is
    that of the plain join, but a step with many repeats costs one row a side, not all its pairs.
    """
    key = list(STEP_KEY)
    steps = gps.where(F.col("vehicle_id").isNotNull() & F.col("timestamp").isNotNull())
    n_gps = steps.groupBy(*key).agg(F.count("*").alias("n_gps"))
    cells = with_position(vehicle.select(*key, "location")).where(has_position())
    n_cells = cells.groupBy(
        *key, cell(F.col("lat"), size).alias("cell_lat"), cell(F.col("lon"), size).alias("cell_lon")
    ).agg(F.count("*").alias("n_vehicle"))
    joined = n_gps.join(n_cells, key, "inner")
    return joined.groupBy("cell_lat", "cell_lon").agg(
        F.sum(F.col("n_gps") * F.col("n_vehicle")).alias("n_points")
    )


def first_arrival(vehicle: DataFrame) -> DataFrame:
    """When each vehicle first was at the destination; vehicles that never were are absent."""
    return arrivals_of(with_position(vehicle.select("vehicle_id", "timestamp", "location")))


def arrivals_of(placed: DataFrame) -> DataFrame:
    """`first_arrival` for rows that already have ``lat`` and ``lon``."""
    there = placed.where(
        has_arrived(F.col("lat"), F.col("lon")) & F.col("vehicle_id").isNotNull()
    )
    return there.groupBy("vehicle_id").agg(F.min("timestamp").alias("arrival"))


def trim_at_arrival(rows: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Rows before their vehicle's arrival; the step that arrives is cut as well.

    ``arrivals`` has at most one row per vehicle. It is written first, so the planner broadcasts
    it by its true size or, where it is too big, shuffles both sides with each join input a plain
    exchange, the form in which adaptive execution splits the task of a busy vehicle (or of the
    rows without a vehicle).
    """
    table = materialize(arrivals, "arrivals").withColumnRenamed("vehicle_id", "_vehicle")
    joined = rows.join(table, rows["vehicle_id"] == table["_vehicle"], "left")
    keep = F.col("arrival").isNull() | (F.col("timestamp") < F.col("arrival"))
    return joined.where(keep).select(*[rows[c] for c in rows.columns])
