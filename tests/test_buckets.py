"""Tables in buckets: joins without an exchange, busy vehicles in all buckets, statistics that the planner sees."""

import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import places
from roadpulse.options import Options
from roadpulse.schemas import GPS, STEP_KEY, VEHICLE, get_schema
from roadpulse.session import scratch_path
from roadpulse.sources.landed import analyze, bucketed, read_landed


@pytest.fixture(scope="module")
def fleet(spark):
    """Two landed tables in which one vehicle has most rows; rows without vehicle or time, repeats."""
    rng = random.Random(4)
    options = Options(base_uri=scratch_path(spark, "fleet"))
    steps = [("hot" if rng.random() < 0.7 else f"v{rng.randrange(20)}", rng.randrange(2000)) for _ in range(4000)]
    steps += [(None, 5), ("hot", None), (None, None)] * 20
    for topic, copies in ((GPS, 1), (VEHICLE, 2)):
        rows = [(f"{topic}{k}", v, t, "[51.%02d,-0.5]" % (k % 90)) for k, (v, t) in enumerate(steps * copies)]
        df = spark.createDataFrame(rows, "id string, vehicle_id string, second long, location string")
        df = df.withColumn("timestamp", F.timestamp_seconds(F.lit(1704067200) + F.col("second")))
        have = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in get_schema(topic)]
        df.select(*have).repartition(5).write.parquet(options.data_path(topic))
    return options


@pytest.fixture
def tables(spark, fleet):
    made = {}
    for topic in (GPS, VEHICLE):
        path = scratch_path(spark, f"buckets-{topic}")
        made[topic] = path.rsplit("/", 1)[1].replace("-", "_")
        bucketed(spark, fleet, topic, made[topic], path, 6)
    yield made
    for name in made.values():
        spark.sql(f"DROP TABLE {name}")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _sorted(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_density_without_an_exchange_below_the_join(spark, fleet, tables, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    laid_out = places.gps_density(spark.table(tables[GPS]), spark.table(tables[VEHICLE]))
    plan = _plan(laid_out)
    assert plan.count("Exchange") == 1 and plan.index("Exchange") < plan.index("Join")
    plain = places.gps_density(read_landed(spark, fleet, GPS), read_landed(spark, fleet, VEHICLE))
    assert _plan(plain).count("Exchange") >= 3
    assert _sorted(laid_out) == _sorted(plain) and laid_out.count() > 0


def test_groups_of_steps_without_an_exchange(spark, tables):
    counted = spark.table(tables[VEHICLE]).groupBy(*STEP_KEY).count()
    assert "Exchange" not in _plan(counted)


def test_rows_stay_and_a_busy_vehicle_is_in_all_buckets(spark, fleet, tables):
    for topic, name in tables.items():
        table = spark.table(name)
        assert _sorted(table) == _sorted(read_landed(spark, fleet, topic))
        files = table.where("vehicle_id = 'hot'").groupBy(F.input_file_name()).count().collect()
        assert len(files) == 6 and max(r["count"] for r in files) < 2 * sum(r["count"] for r in files) / 6


def test_the_planner_builds_from_the_smaller_side(spark, tables, conf):
    """By counted rows that pass a filter, which sizes of files do not tell."""
    conf("spark.sql.cbo.enabled", "true")
    conf("spark.sql.cbo.planStats.enabled", "true")

    def statistics(df):
        return df._jdf.queryExecution().optimizedPlan().stats().rowCount()

    few = spark.table(tables[VEHICLE]).where("vehicle_id = 'v3'")
    assert not statistics(few).isDefined()
    analyze(spark, tables.values(), {tables[VEHICLE]: STEP_KEY})
    few = spark.table(tables[VEHICLE]).where("vehicle_id = 'v3'")
    rows = int(str(statistics(few).get()))
    assert 0 < rows < 0.2 * spark.table(tables[VEHICLE]).count()
    # Both sides are filtered; of what is left, the gps table has half.
    conf("spark.sql.autoBroadcastJoinThreshold", "60000")
    gps = spark.table(tables[GPS])
    assert "BuildRight" in _plan(few.join(gps, list(STEP_KEY)))
    assert "BuildLeft" in _plan(gps.join(few, list(STEP_KEY)))
