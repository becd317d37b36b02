import collections
import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import fleet, places, quality
from roadpulse.operators.running import running
from roadpulse.operators.series import emergency_measures, series, vehicle_measures
from roadpulse.options import Options
from roadpulse.schemas import get_schema
from roadpulse.session import scratch_path
from roadpulse.sources.landed import compact, read_landed, register_tables, sql

START = dt.datetime(2024, 1, 1)
VEHICLE_DDL = "id string, vehicle_id string, timestamp timestamp, location string, speed double"


def _at(seconds):
    return START + dt.timedelta(seconds=seconds)


def _vehicles(spark, rows, parts=3):
    """Vehicle rows, from files like a landed table."""
    path = scratch_path(spark, "vehicles")
    spark.createDataFrame(rows, VEHICLE_DDL).repartition(parts).write.parquet(path)
    return spark.read.parquet(path)


def _hot_fleet(seed=1):
    """A fleet in which one vehicle has most rows, one record hundreds of copies, some rows no
    vehicle, time or position."""
    rng = random.Random(seed)
    rows = []
    for i in range(600):
        v = "hot" if rng.random() < 0.7 else f"v{rng.randrange(6)}"
        lat, lon = 51.5 + rng.randrange(30) / 20, -0.1 - rng.randrange(30) / 10
        rows.append((f"r{i:04d}", v, _at(rng.randrange(200)), f"[{lat},{lon}]", float(i % 40)))
    rows += [("copy", "hot", _at(50), "[51.9,-1.0]", 20.0)] * 300
    rows += [("q1", None, _at(1), "[51.9,-1.0]", 1.0), ("q2", "v1", None, "[51.9,-1.0]", 1.0)]
    rows += [("q3", "v1", _at(3), "nowhere", None), ("q4", "v1", _at(4), None, math.nan)]
    rows += [(None, None, None, None, None)] * 40
    return rows


def _position(text):
    if text is None or not text.startswith("["):
        return None
    lat, lon = text[1:-1].split(",")
    return float(lat), float(lon)


def _key(row):
    """Nulls first, as the engine orders them."""
    return tuple((v is not None, v) for v in row)


def _routes_by_hand(rows):
    by_vehicle = collections.defaultdict(list)
    for id_, v, t, loc, _ in rows:
        if v is not None and _position(loc) is not None:
            by_vehicle[v].append((t, id_, *_position(loc)))
    want = []
    for v, points in by_vehicle.items():
        want += [(v, seq, *point) for seq, point in enumerate(sorted(points, key=_key), 1)]
    return sorted(want, key=_key)


@pytest.mark.parametrize("range_rows", [10**6, 40, 7])
@pytest.mark.parametrize("partitions", ["1", "3", "16"])
def test_routes_against_brute_force(spark, conf, partitions, range_rows):
    conf("spark.sql.shuffle.partitions", partitions)
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = _hot_fleet()
    got = places.routes(_vehicles(spark, rows), range_rows).collect()
    assert sorted(map(tuple, got), key=_key) == _routes_by_hand(rows)


def _counts(df, *columns):
    return [r["count"] for r in df.groupBy(*columns).count().collect()]


def test_a_busy_vehicle_is_cut_into_even_ranges(spark):
    """By time, however unevenly its records lie in it."""
    rows = [(f"i{n}", "hot", START + dt.timedelta(seconds=n if n % 3 else n * n), "[51.9,-1.0]", 1.0) for n in range(20000)]
    rows += [(f"c{n}", f"cold{n % 50}", START + dt.timedelta(seconds=n), "[51.9,-1.0]", 1.0) for n in range(5000)]
    ranged, instants = places.in_ranges(_vehicles(spark, rows), 1000)
    hot = _counts(ranged.where("vehicle_id = 'hot'"), "_range")
    assert not instants and sum(hot) == 20000 and len(hot) >= 18 and max(hot) < 1500
    assert _counts(ranged.where("vehicle_id <> 'hot'"), "vehicle_id", "_range") == [100] * 50
    assert sorted(map(tuple, places.routes(_vehicles(spark, rows), 1000).collect()), key=_key) == _routes_by_hand(rows)


def test_copies_of_one_record_are_counted_and_spread(spark, conf, monkeypatch):
    """A third of all rows is one record, another lot has no time; no task sorts or sends out a pile of copies."""
    monkeypatch.setattr(places, "COPY_ROWS", 500)
    conf("spark.sql.shuffle.partitions", "8")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [("same", "hot", START, "[51.9,-1.0]", 1.0)] * 10000
    rows += [("none", "hot", None, "[51.9,-1.0]", 1.0)] * 5000
    rows += [(f"i{n}", "hot", START + dt.timedelta(seconds=n - 3000), "[51.9,-1.0]", 1.0) for n in range(6000)]
    vehicle = _vehicles(spark, rows)
    ranged, instants = places.in_ranges(vehicle, 1000)
    assert instants and max(_counts(ranged.where("not _single"), "_range")) < 1500
    routes = places.routes(vehicle, 1000)
    assert sorted(map(tuple, routes.collect()), key=_key) == _routes_by_hand(rows)
    copies = places._numbered_copies(ranged, ["vehicle_id", "_range"], ("timestamp", "id", "lat", "lon"))
    per_task = _counts(copies.withColumn("task", F.spark_partition_id()), "task")
    assert sum(per_task) >= 15000 and len(per_task) == 8 and max(per_task) < 0.4 * sum(per_task)


def test_routes_write_nothing(spark, monkeypatch):
    monkeypatch.setattr(places, "materialize", None)
    assert places.routes(_vehicles(spark, _hot_fleet()), 20).count() > 0


def test_latest_position_against_brute_force(spark):
    rows = _hot_fleet(2)
    got = places.latest_position(_vehicles(spark, rows)).collect()
    best = {}
    for id_, v, t, loc, _ in rows:
        if v is not None and t is not None and _position(loc) is not None:
            best[v] = max(best.get(v, (START, "")), (t, id_, *_position(loc)))
    assert sorted(map(tuple, got)) == sorted((v, b[0], *b[2:]) for v, b in best.items())


def test_density_equals_the_plain_join_also_with_repeats(spark):
    rows = _hot_fleet(3)
    vehicle = _vehicles(spark, rows)
    gps_rows = [(r[1], r[2]) for r in rows[::2]] + [("hot", _at(50))] * 25 + [("x", _at(1))]
    gps = spark.createDataFrame(gps_rows, "vehicle_id string, timestamp timestamp")
    got = {
        (r["cell_lat"], r["cell_lon"]): r["n_points"]
        for r in places.gps_density(gps, vehicle).collect()
    }
    at_step = collections.Counter(
        ((v, t), (math.floor(p[0] / 0.05), math.floor(p[1] / 0.05)))
        for _, v, t, loc, _ in rows
        if v is not None and t is not None and (p := _position(loc)) is not None
    )
    n_gps = collections.Counter(gps_rows)
    want = collections.Counter()
    for (step, cell), n in at_step.items():
        want[cell] += n * n_gps[step]
    assert got == {c: n for c, n in want.items() if n}


def test_density_counts_before_it_joins(spark):
    df = _vehicles(spark, _hot_fleet())
    plan = places.gps_density(df, df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner") < plan.index("count(1)")


def test_trim_against_brute_force(spark):
    rows = _hot_fleet(4)
    vehicle = _vehicles(spark, rows)
    arrivals = {}
    for _, v, t, loc, _ in rows:
        p = _position(loc)
        if v and t and p and p[0] >= 52.4862 and p[1] <= -1.8904:
            arrivals[v] = min(arrivals.get(v, t), t)
    assert arrivals
    got = places.first_arrival(vehicle)
    assert {r["vehicle_id"]: r["arrival"] for r in got.collect()} == arrivals
    kept = places.trim_at_arrival(vehicle, got)
    want = [r for r in rows if r[1] not in arrivals or (r[2] and r[2] < arrivals[r[1]])]
    assert kept.count() == len(want)
    assert kept.columns == vehicle.columns
    assert collections.Counter(r["id"] for r in kept.collect()) == collections.Counter(
        r[0] for r in want
    )


def test_trim_splits_the_task_of_a_busy_vehicle(spark, conf):
    """Where arrivals are too many to broadcast, adaptive execution cuts the hot partition."""
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        conf(key, "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10KB")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "8")
    rng = random.Random(5)
    rows = [
        (f"r{i}-{rng.random()}", "hot" if i % 3 else f"v{i}", _at(i), "[52.5,-1.9]", 1.0)
        for i in range(9000)
    ]
    vehicle = _vehicles(spark, rows, parts=6)
    arrivals = places.first_arrival(vehicle).where("vehicle_id != 'v0'")
    kept = places.trim_at_arrival(vehicle, arrivals)
    assert kept.count() == 1
    again = places.trim_at_arrival(vehicle, arrivals)
    again.collect()
    assert "skew=true" in again._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_running_against_brute_force(spark, chunk):
    rng = random.Random(6)
    rows = []
    for key, n in (("hot", 500), ("a", 3), (None, 20)):
        for i in rng.sample(range(n * 2), n):
            rows.append((key, i, *(None if rng.random() < 0.2 else rng.randrange(100) for _ in range(2))))
    df = spark.createDataFrame(rows, "k string, i bigint, x bigint, y bigint")
    got = running(df, ["k"], "i", sums={"s": "x"}, maxima={"m": "y"}, chunk=chunk)
    want = []
    for key in ("hot", "a", None):
        total, top = None, None
        for row in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            total = row[2] if total is None else total + (row[2] or 0)
            top = row[3] if top is None else top if row[3] is None else max(top, row[3])
            want.append((*row, total, top))
    assert sorted(map(tuple, got.collect()), key=_key) == sorted(want, key=_key)


def test_late_rows(spark):
    clock = [0, 300, 100, 200, 290, None, 150, 400, 279, 280]
    rows = [(n, None if s is None else _at(s), "t", 0, n) for n, s in enumerate(clock)]
    rows += [(100, _at(1), "t", 1, 0)]
    df = spark.createDataFrame(
        rows,
        "id int, timestamp timestamp, source_topic string, source_partition int, source_offset bigint",
    )
    for chunk in (2, 3, 1000):
        late = quality.late_rows(df, chunk=chunk).where("late").select("id").collect()
        assert sorted(r[0] for r in late) == [2, 6, 8]


def test_range_violations(spark):
    table = lambda topic, rows: spark.createDataFrame(
        rows, ", ".join(f"{f} double" for f in quality.RANGES[topic])
    )
    tables = {
        "vehicle_data": table("vehicle_data", [(9.9,), (10.0,), (40.0,), (41.0,), (None,)]),
        "gps_data": table("gps_data", [(-1.0,), (0.0,)]),
        "weather_data": table("weather_data", [(-6.0, 26.0, 101.0, 50.0, 501.0)] * 2),
    }
    found = {(r[0], r[1]): (r[2], r[3]) for r in quality.range_violations(tables).collect()}
    assert found[("vehicle_data", "speed")] == (1, 1)
    assert found[("gps_data", "speed")] == (1, 0)
    assert found[("weather_data", "temperature")] == (2, 0)
    assert found[("weather_data", "precipitation")] == (0, 2)
    assert found[("weather_data", "humidity")] == (0, 0)
    assert found[("weather_data", "airQualityIndex")] == (0, 2)


def test_mean_speed_leaves_out_what_is_no_number(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("a", math.nan), ("b", None)], "v string, speed double")
    assert fleet.avg_speed(df).first()[0] == 15.0
    assert {tuple(r) for r in fleet.avg_speed(df, ["v"]).collect()} == {("a", 15.0)}


def test_incidents_and_records_differ(spark):
    df = spark.createDataFrame([("Fire",), ("None",), (None,), ("Police",)], "type string")
    assert tuple(fleet.incident_count(df).first()) == (4, 2)


def test_shares_have_null_as_a_category(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "c string")
    shares = fleet.category_share(df, "c")
    assert {r[0]: (r[1], r[2]) for r in shares.collect()} == {
        "x": (2, 0.5), None: (1, 0.25), "y": (1, 0.25),
    }
    assert "Window" not in shares._jdf.queryExecution().executedPlan().toString()


def test_detail_is_a_top_k(spark):
    df = spark.createDataFrame([(f"i{n}", n % 3) for n in range(20)], "id string, x int")
    top = fleet.detail(df, F.col("x") > 0, [F.col("x").desc()], 3)
    assert [r["id"] for r in top.collect()] == ["i11", "i14", "i17"]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_series_buckets_start_at_the_epoch_grid(spark):
    df = spark.createDataFrame([(_at(0), 1.0), (_at(3599), 3.0), (_at(7200), math.nan), (None, 9.0)], "timestamp timestamp, speed double")
    rows = series(df, vehicle_measures()).orderBy("bucket_start").collect()
    assert [tuple(r) for r in rows] == [(_at(0), 2, 2.0), (_at(7200), 1, None)]
    plan = series(df, vehicle_measures())._jdf.queryExecution().executedPlan().toString()
    assert "partial_avg" in plan and "SortAggregate" not in plan


def test_series_of_incidents(spark):
    df = spark.createDataFrame([(_at(0), "None"), (_at(1), "Fire"), (_at(2), None)], "timestamp timestamp, type string")
    assert tuple(series(df, emergency_measures()).first()) == (_at(0), 3, 1)


@pytest.fixture(scope="module")
def landed(spark):
    options = Options(base_uri=scratch_path(spark, "tables"))
    for topic in ("vehicle_data", "gps_data"):
        schema = get_schema(topic)
        rows = [
            tuple(
                _at(i) if f.dataType.simpleString() == "timestamp" else None for f in schema
            )
            for i in range(50)
        ]
        df = spark.createDataFrame(rows, schema).withColumn("id", F.col("timestamp").cast("string"))
        df.repartition(25).write.parquet(options.data_path(topic))
    spark.createDataFrame([], get_schema("weather_data")).where("false").write.parquet(
        options.data_path("weather_data")
    )
    return options


def test_views_and_parameters(spark, landed):
    assert register_tables(spark, landed, ["vehicle_data", "weather_data"]) == [
        "vehicle_data", "weather_data",
    ]
    assert spark.table("weather_data").schema == get_schema("weather_data")
    text = "SELECT count(*) AS n FROM vehicle_data WHERE id >= :start"
    assert sql(spark, text, start="2024-01-01 00:00:40").first()[0] == 10
    assert sql(spark, "SELECT count(*) FROM weather_data").first()[0] == 0
    assert sql(spark, text, start="' OR true --").first()[0] == 50


def test_external_tables(spark, landed):
    spark.sql("CREATE DATABASE IF NOT EXISTS fleet_test")
    try:
        names = register_tables(spark, landed, ["gps_data"], database="fleet_test")
        assert names == register_tables(spark, landed, ["gps_data"], database="fleet_test")
        assert spark.table("fleet_test.gps_data").count() == 50
    finally:
        spark.sql("DROP DATABASE fleet_test CASCADE")


def test_external_table_over_dates(spark, tmp_path):
    """All dates are found, later ones too; another folder under the name is refused."""
    options = Options(base_uri=str(tmp_path))
    day = lambda n: spark.createDataFrame(
        [(f"g{n}", dt.date(2024, 1, n))], "id string, event_date date"
    )
    folder = options.data_path("gps_data")
    spark.sql("CREATE DATABASE IF NOT EXISTS dated_test")
    try:
        day(1).union(day(2)).write.partitionBy("event_date").parquet(folder)
        register_tables(spark, options, ["gps_data"], database="dated_test")
        assert spark.table("dated_test.gps_data").count() == 2
        day(3).write.mode("append").partitionBy("event_date").parquet(folder)
        register_tables(spark, options, ["gps_data"], database="dated_test")
        assert spark.table("dated_test.gps_data").count() == 3
        with pytest.raises(ValueError, match="gps_data"):
            register_tables(spark, Options(base_uri=str(tmp_path / "x")), ["gps_data"], database="dated_test")
    finally:
        spark.sql("DROP DATABASE dated_test CASCADE")


def test_landed_tables_stay(spark, landed):
    assert read_landed(spark, landed, "gps_data").count() == 50


def test_compaction_keeps_rows_and_leaves_fewer_files(spark, landed):
    before = read_landed(spark, landed, "gps_data")
    after = compact(spark, landed, "gps_data", scratch_path(spark, "compacted"))
    assert sorted(before.collect()) == sorted(after.collect())
    assert len(after.inputFiles()) == 1 < len(before.inputFiles())
    path = scratch_path(spark, "compacted")
    assert len(compact(spark, landed, "gps_data", path, file_bytes=10_000).inputFiles()) > 1
