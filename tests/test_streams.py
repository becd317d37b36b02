import datetime as dt
import os
import signal
import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from roadpulse.operators.decode import decode
from roadpulse.operators.quality import drop_repeats, drop_repeats_stream
from roadpulse.operators.series import emergency_measures, series
from roadpulse.options import Options
from roadpulse.plans.landing import event_source, fresh_options, land_topics
from roadpulse.plans.queries import all_queries
from roadpulse.operators.encode import envelopes
from roadpulse.plans.steps import damaged, messages, read_events, steps, stream_steps
from roadpulse.schemas import TOPICS
from roadpulse.session import scratch_path
from roadpulse.sources.files import read_log_topic, side_by_side, write_log
from roadpulse.sources.landed import compact, read_landed, stream_landed
from roadpulse.streaming.ingest import ingest, run, start_all, stop_all, supervise
from roadpulse.streaming.live import gps_position_stream, quarantine
from roadpulse.streaming.publish import publish
from roadpulse.streaming.sinks import parquet_writer

DAY = dt.date(2024, 1, 1)


def _record(name, clock):
    return f'{{"id":"{name}","vehicle_id":"v","timestamp":"{DAY}T{clock}:00"}}'


BATCHES = [
    [_record("n1", "10:00"), _record("n2", "10:10")],
    [_record("late", "08:00"), _record("n1", "10:00"), "garbage", None],
    [_record("n3", "10:11"), _record("n2", "10:10"), _record("late2", "08:00")],
]


def _append(spark, path, texts, topic="gps_data"):
    """One file of messages; later files are newer, so that they are read later."""
    time.sleep(1.1)
    rows = [(None if t is None else bytearray(t.encode()), topic) for t in texts]
    write_log(spark.createDataFrame(rows, "value binary, topic string").coalesce(1), path)


@pytest.fixture(scope="module")
def log(spark):
    path = scratch_path(spark, "test-log")
    for batch in BATCHES:
        _append(spark, path, batch)
    return path


def _ids(df):
    return sorted(str(r["id"]) for r in df.select("id").collect())


def _land(spark, path, options, topic="gps_data"):
    supervise(start_all(spark, options, [topic], lambda t: read_log_topic(spark, path, t, options)))
    return read_landed(spark, options, topic)


def _run(spark, stream, name, **schema):
    base = scratch_path(spark, name)
    query = parquet_writer(stream, f"{base}/data", f"{base}/checkpoint", "available").start()
    run(query)
    return spark.read.schema(stream.schema).parquet(f"{base}/data"), query


EVERYTHING = ["None", "None", "late", "late2", "n1", "n1", "n2", "n2", "n3"]


def test_late_and_repeated_rows_are_kept_and_a_restart_adds_only_what_is_new(spark, log):
    path = scratch_path(spark, "test-log")
    for batch in BATCHES:
        _append(spark, path, batch)
    options = fresh_options(spark, "late", max_files_per_trigger=1)
    assert _ids(_land(spark, path, options)) == EVERYTHING
    assert _ids(_land(spark, path, options)) == EVERYTHING
    _append(spark, path, [_record("n4", "10:12")])
    assert _ids(_land(spark, path, options)) == EVERYTHING + ["n4"]


def test_first_run_sees_files_of_any_age(spark, log, tmp_path):
    """Files far older than the newest are read too, also when they come in a later batch."""
    path = str(tmp_path / "log")
    for n in range(3):
        _append(spark, path, [_record(f"n{n}", "10:00")])
    folder = f"{path}/topic=gps_data"
    parts = sorted(f for f in os.listdir(folder) if f.startswith("part"))
    for age, part in zip((400, 90, 0), parts):
        then = time.time() - age * 86400
        os.utime(f"{folder}/{part}", (then, then))
    options = fresh_options(spark, "old", max_files_per_trigger=1)
    assert _ids(_land(spark, path, options)) == ["n0", "n1", "n2"]


def test_repeats_are_dropped_within_the_watermark(spark, log):
    options = Options(max_files_per_trigger=1)
    decoded = decode(read_log_topic(spark, log, "gps_data", options), "gps_data")
    rows, _ = _run(spark, drop_repeats_stream(decoded), "dedup")
    # A batch drops late rows by the watermark of the batch before, so the first late one stays.
    # What has no id cannot be told apart and stays.
    assert _ids(rows) == ["None", "None", "late", "n1", "n2", "n3"]
    assert _ids(drop_repeats(decode(spark.read.parquet(f"{log}/topic=gps_data"), "gps_data"))) == [
        "None", "None", "late", "late2", "n1", "n2", "n3",
    ]


def test_rows_without_an_id_pass(spark):
    path = scratch_path(spark, "no-id-log")
    clock = f'"timestamp":"{DAY}T10:00:00"'
    _append(spark, path, [_record("a", "10:00"), "{" + clock + "}", '{"ID":"c",' + clock + "}"])
    decoded = decode(read_log_topic(spark, path, "gps_data"), "gps_data")
    rows, _ = _run(spark, drop_repeats_stream(decoded), "no-id")
    assert _ids(rows) == ["None", "None", "a"]


@pytest.mark.parametrize("thin", [False, True])
def test_a_late_first_copy_does_not_take_the_second_with_it(spark, thin):
    path = scratch_path(spark, "late-first")
    for batch in (
        [_record("n0", "12:00")],
        [_record("n1", "12:01")],
        [_record("x", "08:00"), _record("x", "12:05")],
    ):
        _append(spark, path, batch)
    options = Options(max_files_per_trigger=1)
    decoded = decode(read_log_topic(spark, path, "gps_data", options), "gps_data")
    rows, _ = _run(spark, drop_repeats_stream(decoded, thin=thin), "late-first")
    assert _ids(rows) == ["n0", "n1", "x"]


def test_a_record_repeated_many_times_is_thinned_before_the_shuffle(spark):
    path = scratch_path(spark, "hot-log")
    _append(spark, path, [_record("hot", "10:00")] * 4000 + [_record(f"n{i}", "10:01") for i in range(50)])
    decoded = decode(read_log_topic(spark, path, "gps_data"), "gps_data")
    rows, query = _run(spark, drop_repeats_stream(decoded, thin=True), "hot")
    assert rows.count() == 51
    first = next(p for p in query.recentProgress if p["numInputRows"])
    state = first["stateOperators"][0]
    assert state["numRowsTotal"] == 51
    assert state["customMetrics"]["numDroppedDuplicateRows"] < 10


def test_repeats_in_a_table(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 3)], "id string, x int")
    assert _ids(drop_repeats(df)) == ["None", "None", "a", "b"]


def test_watermark_mark_does_not_reach_readers(spark, log):
    options = fresh_options(spark, "mark")
    _land(spark, log, options)
    stored = spark.read.parquet(options.data_path("gps_data"))
    assert stored.schema["timestamp"].metadata == {"spark.watermarkDelayMs": 120000}
    assert read_landed(spark, options, "gps_data").schema["timestamp"].metadata == {}
    forgetful = stream_landed(spark, options, "gps_data").groupBy(F.window("timestamp", "1 hour")).count()
    with pytest.raises(AnalysisException):
        _run(spark, forgetful, "forgetful")


def test_landing_by_date_prunes(spark, log):
    options = fresh_options(spark, "dated", partition_by_date=True)
    rows = _land(spark, log, options)
    assert _ids(rows) == EVERYTHING
    some = rows.where(F.col("event_date") == F.lit(DAY))
    assert some.count() == 7
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_compaction_of_a_table_landed_by_date(spark, sf_dir):
    options = fresh_options(spark, "dated-all", partition_by_date=True)
    dealt = lambda topic: messages(stream_steps(spark, sf_dir).repartition(4), topic)
    supervise(start_all(spark, options, ["gps_data"], dealt))
    before = read_landed(spark, options, "gps_data")
    after = compact(spark, options, "gps_data", scratch_path(spark, "dated-compact"), 20_000)
    columns = sorted(before.columns)
    assert sorted(after.columns) == columns and "event_date" in columns
    assert after.count() == before.count()
    assert after.select(columns).exceptAll(before.select(columns)).isEmpty()
    dates = before.select("event_date").distinct().count()
    assert dates <= len(after.inputFiles()) < len(before.inputFiles())


def test_unknown_topic_starts_nothing(spark):
    before = len(spark.streams.active)
    with pytest.raises(ValueError):
        start_all(spark, fresh_options(spark, "none"), ["gps_data", "other"], lambda t: None)
    assert len(spark.streams.active) == before


def test_a_topic_that_cannot_start_stops_the_others(spark, log):
    options = fresh_options(spark, "partial").with_(trigger="1 hour")

    def source(topic):
        if topic == "weather_data":
            raise OSError("no such topic")
        return read_log_topic(spark, log, topic, options)

    with pytest.raises(OSError):
        start_all(spark, options, ["gps_data", "weather_data"], source)
    assert not spark.streams.active


def test_the_query_that_fails_is_seen_wherever_it_stands(spark, log):
    """The second query fails while the first would run on for ever."""
    options = fresh_options(spark, "failing").with_(trigger="100 milliseconds")
    good = read_log_topic(spark, log, "gps_data", options)
    bad = good.withColumn("value", F.raise_error(F.lit("broken message")).cast("binary"))
    queries = start_all(
        spark, options, ["gps_data", "weather_data"], lambda t: good if t == "gps_data" else bad
    )
    with pytest.raises(Exception, match="broken message"):
        supervise(queries)
    assert not any(q.isActive for q in queries)


def test_names_and_stop(spark, log):
    options = fresh_options(spark, "stop").with_(trigger="1 hour")
    queries = start_all(spark, options, ["gps_data"], lambda t: read_log_topic(spark, log, t, options))
    assert [q.name for q in queries] == ["gps_data"]
    stop_all(queries)
    stop_all(queries)
    assert not spark.streams.active


def test_signal_stops_all_and_exits_cleanly(spark, log, tmp_path):
    """The job itself, in a process of its own, told to end."""
    program = textwrap.dedent(
        f"""
        from roadpulse.session import create_session
        create_session("local[1]", extra={{"spark.ui.enabled": "false",
                                           "spark.ui.showConsoleProgress": "false"}})
        from roadpulse.streaming import job
        job.TOPICS = ("gps_data",)
        print("ready", flush=True)
        job.main(["--base-uri", {str(tmp_path)!r}, "--log", {log!r}, "--trigger", "1 second"])
        """
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    child = subprocess.Popen(
        [sys.executable, "-c", program],
        cwd=root,
        stdout=subprocess.PIPE,
        stderr=subprocess.DEVNULL,
        text=True,
        start_new_session=True,
    )
    try:
        for line in child.stdout:
            if line.strip() == "ready":
                break
        landed = tmp_path / "data" / "gps_data" / "_spark_metadata"
        deadline = time.time() + 60
        while time.time() < deadline and not (landed / "0").exists():
            time.sleep(0.3)
        child.send_signal(signal.SIGTERM)
        assert child.wait(60) == 0
    finally:
        if child.poll() is None:
            child.kill()
    assert (landed / "0").exists()


def test_bad_messages_go_to_the_side_table_and_the_rest_to_the_table(spark, sf_dir):
    path = scratch_path(spark, "damaged-log")
    rows = damaged(steps(read_events(spark, sf_dir)), "event_id")
    rows.write.parquet(path)
    n = rows.count()
    stream = spark.readStream.schema(rows.schema).parquet(path)
    sound, unsound = quarantine(stream, "gps_data", "event_id")
    good, _ = _run(spark, sound, "sound")
    bad, _ = _run(spark, unsound, "unsound")
    unsound_ways = {3, 6, 9} | set(range(12, 23))
    assert bad.count() == rows.where(F.col("damage").isin(unsound_ways)).count() > 0
    assert good.count() == n - bad.count()
    problems = {r[0] for r in bad.select("problem").distinct().collect()}
    assert problems == {"empty", "malformed", "keyless"}


def test_closed_buckets_of_a_stream_equal_the_batch(spark, sf_dir):
    options = fresh_options(spark, "series")
    land_topics(spark, sf_dir, options, ["emergency_data"])
    table = read_landed(spark, options, "emergency_data")
    live = stream_landed(spark, options, "emergency_data").withWatermark("timestamp", "2 minutes")
    rows, _ = _run(spark, series(live, emergency_measures(), "6 hours"), "buckets")
    end = table.agg(F.max("timestamp") - F.expr("INTERVAL 2 MINUTES")).first()[0]
    batch = series(table, emergency_measures(), "6 hours")
    closed = batch.where(F.col("bucket_start") + F.expr("INTERVAL 6 HOURS") <= F.lit(end))
    assert sorted(rows.collect()) == sorted(closed.collect())
    assert 0 < rows.count() < batch.count()


@pytest.mark.parametrize("salts", [1, 5])
def test_live_positions_give_each_record_one(spark, sf_dir, salts):
    """Also where records and positions repeat."""
    twice = steps(read_events(spark, sf_dir)).withColumn("c", F.explode(F.array(F.lit(1), F.lit(2))))
    path = scratch_path(spark, "twice-log")
    for topic in ("gps_data", "vehicle_data"):
        write_log(messages(twice, topic), path)
    gps, vehicle = (decode(read_log_topic(spark, path, t), t) for t in ("gps_data", "vehicle_data"))
    rows, _ = _run(spark, gps_position_stream(gps, vehicle, salts=salts), "positions")
    n = read_events(spark, sf_dir).count()
    assert rows.count() == n == rows.select("id").distinct().count()


def test_live_positions_with_missing_ids_and_steps_of_two_positions(spark):
    def record(name, clock, more):
        text = "null" if name is None else f'"{name}"'
        return f'{{"id":{text},"vehicle_id":"v","timestamp":"{DAY}T{clock}:00"{more}}}'

    path = scratch_path(spark, "positions-log")
    _append(spark, path, [record("g1", "10:00", ""), record(None, "10:00", ""), record("g1", "10:00", "")])
    places = [record("v1", "10:00", ',"location":[1.0,2.0]'), record("v2", "10:00", ',"location":[3.0,4.0]')]
    _append(spark, path, places + places[:1], "vehicle_data")
    gps, vehicle = (decode(read_log_topic(spark, path, t), t) for t in ("gps_data", "vehicle_data"))
    rows, _ = _run(spark, gps_position_stream(gps, vehicle), "positions")
    found = sorted((str(r["id"]), r["location"]) for r in rows.collect())
    assert found == [(i, p) for i in ("None", "g1") for p in ("[1.0,2.0]", "[3.0,4.0]")]


def test_result_does_not_depend_on_the_split_into_files(spark, sf_dir):
    rows = messages(steps(read_events(spark, sf_dir)), "weather_data")
    results = []
    for parts in (1, 7):
        path = scratch_path(spark, f"split-{parts}")
        write_log(rows.repartition(parts), path)
        options = fresh_options(spark, "split", max_files_per_trigger=2)
        results.append(sorted(map(str, _land(spark, path, options, "weather_data").collect())))
    assert results[0] == results[1]


def test_landing_all_topics_reads_what_was_sent(spark, sf_dir):
    options = fresh_options(spark, "all")
    land_topics(spark, sf_dir, options)
    n = read_events(spark, sf_dir).count()
    assert {t: read_landed(spark, options, t).count() for t in TOPICS} == {t: n for t in TOPICS}
    source = event_source(spark, sf_dir)
    assert ingest(source("gps_data"), "gps_data", options).isStreaming
    assert len(all_queries()) == 51


def test_landing_many_small_splits(spark, sf_dir, tmp_path, conf):
    """The plan is the same for a table of many files, each read in several splits."""
    conf("spark.sql.files.maxPartitionBytes", "4096")
    conf("spark.sql.files.openCostInBytes", "0")
    read_events(spark, sf_dir).repartition(24).write.parquet(str(tmp_path / "events.parquet"))
    assert read_events(spark, str(tmp_path)).rdd.getNumPartitions() >= 24
    one, many = fresh_options(spark, "one"), fresh_options(spark, "many")
    land_topics(spark, sf_dir, one, ["weather_data"])
    land_topics(spark, str(tmp_path), many, ["weather_data"])
    whole, split = (read_landed(spark, o, "weather_data") for o in (one, many))
    assert split.count() == whole.count() and split.exceptAll(whole).isEmpty()


def test_publishing_goes_on_as_steps_come(spark, sf_dir):
    path, checkpoint = scratch_path(spark, "sent"), scratch_path(spark, "sent-checkpoint")
    sent = envelopes(stream_steps(spark, sf_dir), "partition", "offset", "timestamp", key="vehicle_id")
    for _ in range(2):  # a second run sends nothing again
        run(publish(sent, Options(trigger="available"), checkpoint, log=path))
    n = read_events(spark, sf_dir).count()
    counts = {r["topic"]: r["count"] for r in spark.read.parquet(path).groupBy("topic").count().collect()}
    assert counts == {t: n for t in TOPICS}
    decoded = decode(read_log_topic(spark, path, "gps_data"), "gps_data")
    rows, _ = _run(spark, decoded, "sent-back")
    assert rows.select("id").distinct().count() == n


def test_a_log_of_all_topics_is_written_without_a_sort(spark, tmp_path):
    """A task's messages of all topics pass through; what it holds does not grow with them."""
    rows = spark.range(3000).selectExpr(
        "cast(cast(id as string) as binary) as value", "case when id % 7 < 6 then concat('t', id % 7) end as topic"
    )
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting)
    write_log(rows.coalesce(1), str(tmp_path / "log"))
    assert spark.conf.get(setting) == before
    back = spark.read.parquet(str(tmp_path / "log")).selectExpr("value", "topic")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    assert len(list((tmp_path / "log").glob("topic=*/*.parquet"))) == 7

    rows.createOrReplaceTempView("messages_in")
    columns = f"(value BINARY, topic STRING) USING parquet PARTITIONED BY (topic) LOCATION '{tmp_path}/table'"
    spark.sql(f"CREATE TABLE log_of_topics {columns}")
    plan = "EXPLAIN INSERT INTO log_of_topics SELECT value, topic FROM messages_in"
    sorted_first = spark.sql(plan).first()[0]
    with side_by_side(spark):
        held_open = spark.sql(plan).first()[0]
    spark.sql("DROP TABLE log_of_topics")
    assert "Sort [topic" in sorted_first and "Sort [topic" not in held_open
