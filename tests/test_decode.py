import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from roadpulse.functions.position import with_position
from roadpulse.operators.decode import decode, decode_checked
from roadpulse.operators.encode import check_encodable, encode, envelopes, fan_out, records
from roadpulse.options import Options
from roadpulse.plans.steps import read_events, steps
from roadpulse.schemas import TOPICS, get_schema

T = dt.datetime

# name, message, expected id, timestamp, location, speed, year, problem
CASES = [
    ("complete", '{"id": "a", "timestamp": "2024-01-01T00:00:30.123456", "location": [51.5, -0.12], '
     '"speed": 12.5, "year": 2024}',
     "a", T(2024, 1, 1, 0, 0, 30, 123456), "[51.5,-0.12]", 12.5, 2024, None),
    ("whole second", '{"id":"b","timestamp":"2024-01-01T00:00:30","location":"x","speed":12,'
     '"year":2024}', "b", T(2024, 1, 1, 0, 0, 30), "x", 12.0, 2024, None),
    ("missing", '{"id":"c"}', "c", None, None, None, None, None),
    ("unknown", '{"id":"d","zzz":1}', "d", None, None, None, None, None),
    ("fraction", '{"id":"e","year":2024.5,"speed":3.0}', "e", None, None, 3.0, None, "malformed"),
    ("text number", '{"id":"f","speed":"12.5","year":1}', "f", None, None, None, 1, "malformed"),
    ("number text", '{"id":7}', "7", None, None, None, None, None),
    ("nan", '{"id":"g","speed":NaN}', "g", None, None, math.nan, None, None),
    ("bad time", '{"id":"h","timestamp":"yesterday","speed":1.0}',
     "h", None, None, 1.0, None, "malformed"),
    ("epoch", '{"id":"i","timestamp":1704067200}', "i", T(2024, 1, 1), None, None, None, None),
    ("zoned", '{"id":"m","timestamp":"2024-01-01T00:00:30+02:00"}',
     "m", T(2023, 12, 31, 22, 0, 30), None, None, None, None),
    ("case", '{"ID":"n"}', None, None, None, None, None, "keyless"),
    ("repeated key", '{"id":"o","id":"p"}', "p", None, None, None, None, None),
    ("object", '{"id":{"a": 1}}', '{"a":1}', None, None, None, None, None),
    ("cut", '{"id":"j","speed":1.0,', None, None, None, None, None, "malformed"),
    ("text", "hello", None, None, None, None, None, "malformed"),
    ("null", "null", None, None, None, None, None, "malformed"),
    ("array", '[{"id":"k"},{"id":"l"}]', None, None, None, None, None, "malformed"),
    ("empty", "", None, None, None, None, None, "empty"),
    ("tombstone", None, None, None, None, None, None, "empty"),
    ("white space", "\n", None, None, None, None, None, "empty"),
    ("tab", "\t", None, None, None, None, None, "empty"),
    ("no fields", "{}", None, None, None, None, None, "keyless"),
    ("null id", '{"id":null}', None, None, None, None, None, "keyless"),
    ("trailing", '{"id":"q"} trailing', "q", None, None, None, None, "malformed"),
    ("two records", '{"id":"r"}{"id":"s"}', "r", None, None, None, None, "malformed"),
    ("two in a row", '{"id":"t"},{"id":"u"}', "t", None, None, None, None, "malformed"),
]
WIDE = (
    "timestamp", "location", "speed", "year",
)


def _messages(spark, texts):
    rows = [(i, None if t is None else bytearray(t.encode())) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "n int, value binary")


def _same(got, want):
    if isinstance(want, float) and math.isnan(want):
        return isinstance(got, float) and math.isnan(got)
    return got == want


def _wall(df):
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def test_edge_cases(spark):
    messages = _messages(spark, [c[1] for c in CASES])
    rows = _wall(decode_checked(messages, "vehicle_data", "n")).orderBy("n").collect()
    assert len(rows) == len(CASES)
    for row, case in zip(rows, CASES):
        got = (row["id"], *[row[c] for c in WIDE], row["problem"])
        assert all(map(_same, got, case[2:])), (case[0], got)


def test_plain_decode_agrees_and_drops_nothing(spark):
    messages = _messages(spark, [c[1] for c in CASES])
    rows = _wall(decode(messages, "vehicle_data")).collect()
    want = sorted(str(c[2]) for c in CASES)
    assert sorted(str(r["id"]) for r in rows) == want
    assert decode(messages, "vehicle_data").columns == get_schema("vehicle_data").fieldNames()


def test_errors_in_unused_fields_are_still_seen(spark):
    """The checked decode must not be narrowed to the columns a query asks for."""
    messages = _messages(spark, ['{"id":"a","year":"x"}', '{"id":"b","year":1}'])
    found = decode_checked(messages, "vehicle_data").where("problem is not null")
    assert found.count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("inline(array(from_json") == 1


def test_origin_is_kept_on_request(spark):
    log = spark.createDataFrame(
        [(b"{}", "gps_data", 3, 17, T(2024, 1, 1))],
        "value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    row = decode(log, "gps_data", keep_origin=True).collect()[0]
    assert (row["source_topic"], row["source_partition"], row["source_offset"]) == ("gps_data", 3, 17)
    assert row["source_time"] is not None and row["timestamp"] is None


def test_a_filter_on_decoded_fields_does_not_decode_again(spark):
    rows = decode(_messages(spark, [c[1] for c in CASES]), "vehicle_data")
    some = rows.where("id is not null and speed > 1 and timestamp is not null")
    assert some._jdf.queryExecution().executedPlan().toString().count("from_json") == 1
    assert sorted(r["id"] for r in some.collect()) == ["a", "b"]


def test_some_columns_only(spark):
    rows = decode(_messages(spark, [CASES[0][1], None]), "vehicle_data", columns=["speed", "id"])
    assert sorted(map(tuple, rows.collect()), key=str) == [(12.5, "a"), (None, None)]


@pytest.mark.parametrize(
    "text,lat,lon",
    [
        ("[51.5,-0.12]", 51.5, -0.12),
        ("[1,2,3]", 1.0, 2.0),
        ("[51.5]", 51.5, None),
        ("[]", None, None),
        ("London", None, None),
        ("", None, None),
        (None, None, None),
        ('{"a":1}', None, None),
    ],
)
def test_positions(spark, text, lat, lon):
    df = spark.createDataFrame([(1, text)], "id int, location string")
    row = with_position(df).collect()
    assert [(r["id"], r["lat"], r["lon"]) for r in row] == [(1, lat, lon)]


def test_filter_on_a_position_does_not_parse_again(spark):
    df = spark.createDataFrame([(1, "[1,2]")], "id int, location string")
    plan = with_position(df).where("lat is not null and lon > 0")._jdf.queryExecution()
    assert plan.executedPlan().toString().count("from_json") == 1


def test_five_records_share_step_key_and_position(spark, sf_dir):
    log = steps(read_events(spark, sf_dir))
    n = log.count()
    by_topic = fan_out(log)
    assert set(by_topic) == set(TOPICS)
    keys = [df.select("vehicle_id", "timestamp").distinct().count() for df in by_topic.values()]
    assert keys == [n] * 5
    sent = envelopes(log)
    assert {r["topic"]: r["count"] for r in sent.groupBy("topic").count().collect()} == {
        t: n for t in TOPICS
    }


def test_topics_can_be_renamed(spark, sf_dir):
    options = Options.from_env({"GPS_TOPIC": "fleet.gps"})
    sent = envelopes(steps(read_events(spark, sf_dir)), options=options)
    assert "fleet.gps" in {r[0] for r in sent.select("topic").distinct().collect()}


@pytest.mark.parametrize("kind", ["binary", "date", "decimal(10,2)", "map<string,int>"])
def test_types_without_a_json_form_are_refused(spark, kind):
    df = spark.createDataFrame([], f"id string, x {kind}")
    with pytest.raises(TypeError, match="not JSON serializable"):
        encode(df, "gps_data")
    with pytest.raises(TypeError):
        check_encodable(spark.createDataFrame([], f"a array<{kind}>").schema)


def test_key_is_the_id_or_a_chosen_column(spark, sf_dir):
    gps = records(steps(read_events(spark, sf_dir)), "gps_data")
    row = encode(gps, "gps_data").first()
    assert row["key"].decode().startswith("g") and row["topic"] == "gps_data"
    assert encode(gps, "gps_data", key="vehicle_id").first()["key"].decode().startswith("V-")
    all_five = envelopes(steps(read_events(spark, sf_dir)), key="vehicle_id")
    assert all_five.where(~F.col("key").cast("string").startswith("V-")).isEmpty()
    assert all_five.select("topic").distinct().count() == 5
    assert not envelopes(steps(read_events(spark, sf_dir))).where(F.col("key").cast("string").startswith("V-")).count()


texts = st.text(st.characters(codec="utf-8", exclude_characters="\x00"), max_size=12)
rows = st.lists(
    st.tuples(
        st.none() | texts,
        st.none() | texts,
        st.none() | st.datetimes(T(1971, 1, 1), T(2100, 1, 1)).map(lambda d: d.replace(fold=0)),
        st.none() | st.floats(allow_nan=False, allow_infinity=False),
        st.none() | texts,
        st.none() | texts,
    ),
    min_size=1,
    max_size=20,
)


@given(rows)
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_decode_undoes_encode(spark, data):
    """Any record, whatever its text and however fine its time, comes back as it was."""
    ntz = "id string, vehicle_id string, timestamp timestamp_ntz, speed double, direction string, vehicleType string"
    df = spark.createDataFrame(data, ntz)
    df = df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    back = _wall(decode(encode(df, "gps_data"), "gps_data")).collect()
    assert sorted(map(repr, (tuple(r) for r in back))) == sorted(map(repr, data))
