"""Repeats that come after any watermark, against a plain pass over the arrivals."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from roadpulse.session import scratch_path
from roadpulse.streaming import once
from roadpulse.streaming.batches import read_batches
from roadpulse.streaming.ingest import run

DAYS = 6


def _arrivals(batches=6, size=60, seed=11):
    """Batches of (device, id, day, arrival): ids that come again days apart, also under another date, one that fills a
    third of every batch, and missing ids and dates."""
    rng = random.Random(seed)
    out = []
    for b in range(batches):
        rows = []
        for i in range(size):
            name = None if rng.random() < 0.1 else rng.randrange(150) if rng.random() < 0.7 else 7
            day = None if rng.random() < 0.1 else rng.randrange(DAYS)
            rows.append((rng.choice("ab"), name, day, b * size + i))
        out.append(rows)
    return out


def _land(spark, batches, base, path, **options):
    ddl = "device string, id long, day int, arrival long"
    for rows in batches:
        df = spark.createDataFrame(rows, ddl).withColumn(
            "timestamp", F.timestamp_seconds(F.lit(1704067200) + F.col("day") * 86400)
        )
        df.drop("day").repartition(3).write.mode("append").parquet(path)
        stream = spark.readStream.schema(df.drop("day").schema).parquet(path)
        run(once.land_once(stream, base, trigger="available", **options))
    return stream


def _check(batches, keys, rows):
    """The null keys all stay; of the others one copy each, of the first batch that has it."""
    at = {"device": 0, "id": 1}
    first, loose = {}, []
    for number, batch in enumerate(batches):
        for row in batch:
            key = tuple(row[at[k]] for k in keys)
            if None in key:
                loose.append(row[3])
            else:
                first.setdefault(key, number)
    size = len(batches[0])
    got = [(tuple(r[k] for k in keys), r["arrival"]) for r in rows]
    assert sorted(a for k, a in got if None in k) == sorted(loose)
    assert sorted((k, a // size) for k, a in got if None not in k) == sorted(first.items())


@pytest.mark.parametrize("keys", [("id",), ("device", "id")])
@pytest.mark.parametrize("keys_a_day, fold", [(1, 2), (50, 3)])
def test_a_record_stands_once(spark, keys, keys_a_day, fold):
    """Also where the filters are so small that they say maybe to everything."""
    base, path, batches = scratch_path(spark, "once"), scratch_path(spark, "once-in"), _arrivals()
    stream = _land(spark, batches, base, path, keys=keys, keys_a_day=keys_a_day, fold=fold)
    _check(batches, keys, once.read_once(spark, stream, base).collect())


@pytest.mark.parametrize("folder", ["asked", "data", "filters", "folded"])
def test_a_batch_cut_short_anywhere_loses_and_doubles_nothing(spark, monkeypatch, folder):
    base, path, batches = scratch_path(spark, "once"), scratch_path(spark, "once-in"), _arrivals(batches=5)
    write, failed = once.write_batch, []

    def cut(df, where, number, *more):
        write(df, where, number, *more)
        if where.endswith(folder) and number == 3 and not failed:
            failed.append(number)
            raise RuntimeError("cut short")

    monkeypatch.setattr(once, "write_batch", cut)
    with pytest.raises(StreamingQueryException):
        _land(spark, batches[:4], base, path, keys_a_day=50, fold=2)
    stream = _land(spark, batches[4:], base, path, keys_a_day=50, fold=2)
    rows = once.read_once(spark, stream, base).collect()
    assert failed
    _check(batches, ["id"], rows)


def test_only_dates_that_may_hold_a_key_are_asked(spark):
    """New keys ask hardly any date, copies one each; folded filters replace their parts."""
    base, path = scratch_path(spark, "once"), scratch_path(spark, "once-in")
    day = lambda d: [("a", d * 500 + i, d, d * 500 + i) for i in range(500)]
    stream = _land(spark, [day(d) for d in range(5)], base, path, keys_a_day=500, fold=2)
    asked = read_batches(spark, f"{base}/asked", stream.select(F.lit(None).cast("date").alias("day"), "id").schema)
    assert asked.count() <= 5
    _land(spark, [[("a", 1200, 2, 9000), ("a", 10**6, 2, 9001)]], base, path, keys_a_day=500, fold=2)
    assert [str(r["day"]) for r in asked.sparkSession.read.parquet(f"{base}/asked").where("id = 1200").collect()] == ["2024-01-03"]
    assert once.read_once(spark, stream, base).count() == 2501
    assert sorted(once.whole_batches(spark, f"{base}/filters")) == [4, 5]
    assert sorted(once.whole_batches(spark, f"{base}/folded")) == [3, 5]


def test_nothing_landed_yet(spark):
    path = scratch_path(spark, "none")
    spark.createDataFrame([], "id string, timestamp timestamp").write.parquet(path)
    stream = spark.readStream.schema("id string, timestamp timestamp").parquet(path)
    assert once.read_once(spark, stream, scratch_path(spark, "once")).count() == 0
