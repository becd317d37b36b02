"""Named queries: every operator run over whole tables, from `events` through landed topics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.position import with_position
from roadpulse.operators import fleet, places, quality
from roadpulse.operators.decode import decode, decode_checked
from roadpulse.operators.encode import encode, envelopes, records
from roadpulse.operators.series import (
    emergency_measures,
    series,
    vehicle_measures,
    weather_measures,
)
from roadpulse.plans.landing import (
    event_source,
    fresh_options,
    land_topics,
    landed,
    landed_buckets,
    landed_options,
    log_path,
)
from roadpulse.plans.steps import (
    damaged,
    messages,
    read_steps,
    stream_steps,
)
from roadpulse.schemas import (
    EMERGENCY,
    GPS,
    STEP_KEY,
    TOPICS,
    TRAFFIC,
    VEHICLE,
    WEATHER,
    get_schema,
    has_position,
)
from roadpulse.session import materialize, pin_utc, scratch_path
from roadpulse.sources.files import read_log_topic, write_log
from roadpulse.sources.landed import read_landed, register_tables, sql
from roadpulse.streaming.batches import (
    land_checked,
    land_late,
    land_series,
    read_checked,
    read_late,
    read_series,
)
from roadpulse.streaming.delivery import read_report
from roadpulse.streaming.ingest import ingest, run, start_all, supervise
from roadpulse.streaming.once import land_once, read_once
from roadpulse.streaming.positions import land_positions, read_positions
from roadpulse.streaming.publish import publish_reported
from roadpulse.streaming.sinks import parquet_writer

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6

ADHOC_SQL = """
SELECT make, year, count(*) AS n_rows, count_if(fuelType = :fuel) AS n_fuel,
       max(speed) AS top_speed
FROM vehicle_data
WHERE speed >= :speed
GROUP BY make, year
"""


def _plain(df: DataFrame) -> DataFrame:
    """Result form: times without a zone, as the SQL engines on the other side have them."""
    return df.select(
        *[
            F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c)
            for c, t in df.dtypes
        ]
    )


def _rounded(df: DataFrame) -> DataFrame:
    means = {c for c in df.columns if c.startswith("avg_")}
    return df.select(*[F.round(c, DIGITS).alias(c) if c in means else F.col(c) for c in df.columns])


def _comparable(df: DataFrame, topic: str) -> DataFrame:
    """A topic's rows with the location as its raw text and as two numbers."""
    if has_position(topic):
        df = with_position(df)
    return _plain(df)


def _written(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over all present input into a folder, and read the folder."""
    spark = stream.sparkSession
    base = scratch_path(spark, name)
    run(parquet_writer(stream, f"{base}/data", f"{base}/checkpoint", "available").start())
    return spark.read.schema(stream.schema).parquet(f"{base}/data")


def _tables(spark: SparkSession, sf_dir: str, *topics: str) -> dict[str, DataFrame]:
    options = landed_options(spark, sf_dir, topics or TOPICS)
    return {t: read_landed(spark, options, t) for t in topics or TOPICS}


# Sources, decode, sinks


def schema_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns of each topic, with how many rows of its landed table fill them."""
    parts = []
    for topic, df in _tables(spark, sf_dir).items():
        fields = get_schema(topic).fields
        counts = df.agg(*[F.count(f.name).alias(f.name) for f in fields])
        rows = [
            F.struct(
                F.lit(topic).alias("topic"),
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col(f.name).alias("n_values"),
            )
            for i, f in enumerate(fields, 1)
        ]
        parts.append(counts.select(F.inline(F.array(*rows))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def decode_stream(topic: str) -> Query:
    """A topic's message log through source, decode and watermark."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        options = fresh_options(spark, f"decode-{topic}")
        source = read_log_topic(spark, log_path(spark, sf_dir), topic, options)
        return _comparable(_written(ingest(source, topic, options), f"decode-{topic}"), topic)

    return query


def land_topic(topic: str) -> Query:
    """A topic's landed table, read back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _comparable(landed(spark, sf_dir, topic), topic)

    return query


def land_all_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five queries at once in one session, into a set of folders of their own."""
    pin_utc(spark)
    options = fresh_options(spark, "land-all")
    land_topics(spark, sf_dir, options)
    parts = [
        read_landed(spark, options, t)
        .agg(
            F.count("*").alias("n_rows"),
            F.min("timestamp").alias("first_time"),
            F.max("timestamp").alias("last_time"),
        )
        .select(F.lit(t).alias("topic"), "n_rows", "first_time", "last_time")
        for t in TOPICS
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return _plain(result)


def decode_edge_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GPS messages damaged in all ways, decoded and checked."""
    pin_utc(spark)
    rows = damaged(read_steps(spark, sf_dir), "event_id")
    checked = decode_checked(rows, GPS, "event_id", "damage")
    return _plain(
        checked.select("event_id", "damage", "id", "vehicle_id", "timestamp", "speed", "problem")
    )


def _waves(spark: SparkSession, sf_dir: str, name: str, n: int = 3):
    """Write a topic's log in ``n`` parts, each spread over all event times; yield after each."""
    path = scratch_path(spark, name)
    for wave in range(n):
        part = read_steps(spark, sf_dir).where(F.col("event_id") % n == wave)
        write_log(messages(part, EMERGENCY), path)
        yield path


def late_rows_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over a log that grows; from the second on most rows are behind the watermark."""
    pin_utc(spark)
    options = fresh_options(spark, "late-kept")
    for path in _waves(spark, sf_dir, "late-log"):
        source = lambda topic, path=path: read_log_topic(spark, path, topic, options)
        supervise(start_all(spark, options, [EMERGENCY], source))
    landed_rows = read_landed(spark, options, EMERGENCY)
    return _plain(landed_rows.select("id", "vehicle_id", "timestamp", "type", "status"))


def resume_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing run twice on one checkpoint: the second run finds nothing new."""
    pin_utc(spark)
    options = fresh_options(spark, "resume")
    for _ in range(2):
        land_topics(spark, sf_dir, options, [GPS])
    return _plain(read_landed(spark, options, GPS))


def series_emergency_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed hours only."""
    pin_utc(spark)
    options = fresh_options(spark, "series")
    rows = ingest(event_source(spark, sf_dir)(EMERGENCY), EMERGENCY, options, ("timestamp", "type"))
    return _plain(_written(series(rows, emergency_measures()), "series"))


def series_emergency_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All hours, also the one under way, after three runs over a log that grows by late rows as well."""
    pin_utc(spark)
    base = scratch_path(spark, "series-live")
    for path in _waves(spark, sf_dir, "series-log"):
        rows = decode(read_log_topic(spark, path, EMERGENCY), EMERGENCY, ("timestamp", "type"))
        run(land_series(rows, emergency_measures(), base, trigger="available"))
    return _plain(read_series(spark, rows, emergency_measures(), base))


# Producer operations


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return read_steps(spark, sf_dir)


def fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        envelopes(_steps(spark, sf_dir), "vehicle_id", "timestamp")
        .groupBy("topic")
        .agg(
            F.count("*").alias("n_records"),
            F.min("timestamp").alias("first_time"),
            F.max("timestamp").alias("last_time"),
        )
        .transform(_plain)
    )


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather records encoded, decoded again."""
    encoded = encode(records(_steps(spark, sf_dir), WEATHER), WEATHER)
    return _comparable(decode(encoded, WEATHER), WEATHER)


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and topic of every message, next to what its payload says."""
    sent = envelopes(_steps(spark, sf_dir))
    body = F.from_json(
        F.col("value").cast("string"), "id STRING, vehicle_id STRING, timestamp TIMESTAMP"
    )
    return _plain(
        sent.select(F.col("key").cast("string").alias("message_key"), "topic", body.alias("b"))
        .select("message_key", "topic", "b.*")
    )


def delivery_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was reported of publishing all messages, and by how much its bytes differ from those that arrived."""
    pin_utc(spark)
    base = scratch_path(spark, "delivery")
    sent = envelopes(stream_steps(spark, sf_dir), "partition", "offset", "timestamp")
    query, report = publish_reported(
        sent, fresh_options(spark, "delivery"), f"{base}/checkpoint", f"{base}/report", f"{base}/log"
    )
    run(query)
    if not report.close():
        raise TimeoutError("no end of the query was reported")
    arrived = spark.read.parquet(f"{base}/log").groupBy("topic").agg(F.sum(F.octet_length("value")).alias("arrived"))
    return (
        read_report(spark, f"{base}/report")
        .groupBy("topic")
        .agg(F.sum("messages").alias("n_messages"), F.sum("keyless").alias("n_keyless"), F.sum("bytes").alias("bytes"))
        .join(arrived, "topic", "left")
        .select("topic", "n_messages", "n_keyless", (F.col("bytes") - F.col("arrived")).alias("bytes_apart"))
    )


def first_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(places.first_arrival(landed(spark, sf_dir, VEHICLE)))


def trim_at_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    vehicle = landed(spark, sf_dir, VEHICLE)
    kept = places.trim_at_arrival(vehicle, places.first_arrival(vehicle))
    return _plain(kept.select("id", "vehicle_id", "timestamp"))


# Analytics


def entries_per_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.entries_per_table(_tables(spark, sf_dir))


def avg_speed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fleet.avg_speed(landed(spark, sf_dir, VEHICLE)))


def avg_speed_by_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(fleet.avg_speed(landed(spark, sf_dir, VEHICLE), ["vehicle_id"]))


def incident_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fleet.incident_count(landed(spark, sf_dir, EMERGENCY))


def over_time(topic: str, measures: Callable[[], list[Column]]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(_rounded(series(landed(spark, sf_dir, topic), measures())))

    return query


def vehicle_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(places.routes(landed(spark, sf_dir, VEHICLE)))


def latest_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(places.latest_position(landed(spark, sf_dir, VEHICLE)))


def gps_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir, GPS, VEHICLE)
    return places.gps_density(tables[GPS], tables[VEHICLE])


def gps_density_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from tables laid out for it: both sides are counted and joined without an exchange."""
    return places.gps_density(landed_buckets(spark, sf_dir, GPS), landed_buckets(spark, sf_dir, VEHICLE))


def share(topic: str, column: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        shares = fleet.category_share(landed(spark, sf_dir, topic), column)
        return shares.withColumn("share", F.round("share", DIGITS))

    return query


def detail_fastest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = landed(spark, sf_dir, VEHICLE)
    top = fleet.detail(rows, F.col("fuelType") == "Electric", [F.col("speed").desc()], 20)
    return _plain(top.select("id", "vehicle_id", "timestamp", "speed", "make", "year"))


def catalog_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of the registered tables as found in their files, with each table's row count."""
    names = register_tables(spark, landed_options(spark, sf_dir))
    parts = []
    for name in names:
        columns = spark.table(name).schema.fields
        rows = [
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("data_type"),
                F.col("n").alias("n_rows"),
            )
            for f in columns
        ]
        counted = spark.table(name).agg(F.count("*").alias("n"))
        parts.append(counted.select(F.inline(F.array(*rows))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def sql_adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_tables(spark, landed_options(spark, sf_dir, [VEHICLE]), [VEHICLE])
    return sql(spark, ADHOC_SQL, fuel="Electric", speed=20.0)


def parse_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_position(landed(spark, sf_dir, TRAFFIC))
    return rows.select("id", "camera_id", "lat", "lon")


# Hardening


def checked(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The damaged messages, landed with their checks in one pass."""
    pin_utc(spark)
    base = scratch_path(spark, "checked")
    rows = damaged(stream_steps(spark, sf_dir), "event_id")
    run(land_checked(rows, GPS, base, "event_id", trigger="available"))
    return read_checked(spark, GPS, base, "event_id BIGINT")


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the damaged messages leave in the side table."""
    return checked(spark, sf_dir)[1]


def checked_sound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What they leave in the table itself."""
    return _plain(checked(spark, sf_dir)[0].select("id", "vehicle_id", "timestamp", "speed"))


def dedup_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream in which every message comes twice, and every tenth a dozen times; every
    seventeenth has no id, and its copies stay."""
    pin_utc(spark)
    copies = F.when(F.col("event_id") % 10 == 0, F.lit(12)).otherwise(F.lit(2))
    name = F.when(F.col("event_id") % 17 != 0, F.col(f"{GPS}.id"))
    rows = stream_steps(spark, sf_dir).withColumn(GPS, F.col(GPS).withField("id", name))
    repeated = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    decoded = decode(messages(repeated, GPS), GPS)
    return _plain(_written(quality.drop_repeats_stream(decoded), "dedup"))


def dedup_days_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log that grows in three parts; every message comes in two or three of them, long after any watermark has
    passed its first copy. Every seventeenth has no id, and its copies stay."""
    pin_utc(spark)
    path, base = scratch_path(spark, "apart-log"), scratch_path(spark, "apart")
    event = F.col("event_id")
    name = F.when(event % 17 != 0, F.col(f"{GPS}.id"))
    sent = read_steps(spark, sf_dir).withColumn(GPS, F.col(GPS).withField("id", name))
    for part in (event % 3 != 2, event % 3 != 0, F.lit(True)):
        write_log(messages(sent.where(part), GPS), path)
        rows = decode(read_log_topic(spark, path, GPS), GPS)
        run(land_once(rows, base, trigger="available"))
    return _plain(read_once(spark, rows, base))


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages(_steps(spark, sf_dir), EMERGENCY)
    table = materialize(decode(sent, EMERGENCY, keep_origin=True), "arrivals-in-order")
    labelled = quality.late_rows(table)
    return labelled.select(
        "id", "source_partition", "source_offset", F.col("late").cast("int").alias("late")
    )


def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same live, from a log that grows in three parts by offset."""
    pin_utc(spark)
    path, base = scratch_path(spark, "late-log"), scratch_path(spark, "late-stream")
    sent = messages(read_steps(spark, sf_dir), EMERGENCY)
    third = (sent.agg(F.max("offset")).first()[0] + 3) // 3
    for part in range(3):
        write_log(sent.where(F.floor(F.col("offset") / third) == part), path)
        rows = decode(read_log_topic(spark, path, EMERGENCY), EMERGENCY, keep_origin=True)
        run(land_late(rows, base, trigger="available"))
    labelled = read_late(spark, rows, base)
    return labelled.select(
        "id", "source_partition", "source_offset", F.col("late").cast("int").alias("late")
    )


def range_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.range_violations(_tables(spark, sf_dir, *quality.RANGES))


def position_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GPS rows with their position, from two streams joined live."""
    pin_utc(spark)
    source = event_source(spark, sf_dir)
    places_only = ("id", *STEP_KEY, "location")
    gps, vehicle = decode(source(GPS), GPS), decode(source(VEHICLE), VEHICLE, columns=places_only)
    base = scratch_path(spark, "positions")
    run(land_positions(gps, vehicle, base, trigger="available"))
    rows = with_position(read_positions(spark, gps, vehicle, base))
    return _plain(rows.select("id", "vehicle_id", "timestamp", "speed", "lat", "lon"))


def all_queries() -> dict[str, Query]:
    return {
        "schema_catalog": schema_catalog,
        **{f"decode_stream_{t}": decode_stream(t) for t in TOPICS},
        "decode_edge_cases": decode_edge_cases,
        "late_rows_kept": late_rows_kept,
        "series_emergency_stream": series_emergency_stream,
        "series_emergency_live": series_emergency_live,
        **{f"land_{t}": land_topic(t) for t in TOPICS},
        "resume_no_duplicates": resume_no_duplicates,
        "land_all_topics": land_all_topics,
        "fanout_counts": fanout_counts,
        "json_roundtrip": json_roundtrip,
        "envelope": envelope,
        "delivery_report": delivery_report,
        "first_arrival": first_arrival,
        "trim_at_arrival": trim_at_arrival,
        "entries_per_table": entries_per_table,
        "avg_speed": avg_speed,
        "avg_speed_by_vehicle": avg_speed_by_vehicle,
        "incident_count": incident_count,
        "series_vehicle": over_time(VEHICLE, vehicle_measures),
        "series_weather": over_time(WEATHER, weather_measures),
        "series_emergency": over_time(EMERGENCY, emergency_measures),
        "vehicle_route": vehicle_route,
        "latest_position": latest_position,
        "gps_density": gps_density,
        "gps_density_bucketed": gps_density_bucketed,
        "share_weather": share(WEATHER, "weatherCondition"),
        "share_incident_type": share(EMERGENCY, "type"),
        "share_incident_status": share(EMERGENCY, "status"),
        "share_vehicle_type": share(GPS, "vehicleType"),
        "share_fuel": share(VEHICLE, "fuelType"),
        "detail_fastest": detail_fastest,
        "catalog_columns": catalog_columns,
        "sql_adhoc": sql_adhoc,
        "parse_position": parse_position,
        "quarantine": quarantined,
        "checked_sound": checked_sound,
        "dedup_by_id": dedup_by_id,
        "dedup_days_apart": dedup_days_apart,
        "late_rows": late_rows,
        "late_rows_stream": late_rows_stream,
        "range_violations": range_violations,
        "gps_position_stream": position_stream,
    }
