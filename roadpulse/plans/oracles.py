"""The same questions in SQL over the `events` table, for an independent engine."""

from __future__ import annotations

from roadpulse.schemas import EMERGENCY, GPS, TOPICS, TRAFFIC, VEHICLE, WEATHER

# The rule that derives the five record kinds from events.
_TOPICS = """
WITH step AS (
  SELECT event_id, user_id, value,
         'V-' || CAST(user_id AS VARCHAR) AS vehicle_id,
         CAST(ts AS TIMESTAMP) AS timestamp,
         CAST(51.5074 AS DOUBLE) + CAST(0.009788 AS DOUBLE) * CAST(event_id % 121 AS DOUBLE) AS lat,
         CAST(-0.1278 AS DOUBLE) - CAST(0.017626 AS DOUBLE) * CAST(event_id % 121 AS DOUBLE) AS lon
  FROM events),
vehicle_data AS (
  SELECT 'v' || CAST(event_id AS VARCHAR) AS id, vehicle_id, timestamp, lat, lon,
         CAST(10 + event_id % 31 AS DOUBLE) AS speed, 'North-East' AS direction,
         CASE user_id % 3 WHEN 0 THEN 'Make-A' WHEN 1 THEN 'Make-B' ELSE 'Make-C' END AS make,
         'Model S' AS model, CAST(2020 + user_id % 5 AS INTEGER) AS year,
         CASE user_id % 2 WHEN 0 THEN 'Electric' ELSE 'Hybrid' END AS "fuelType"
  FROM step),
gps_data AS (
  SELECT 'g' || CAST(event_id AS VARCHAR) AS id, vehicle_id, timestamp,
         CAST(event_id % 41 AS DOUBLE) AS speed, 'North-East' AS direction,
         CASE user_id % 4 WHEN 0 THEN 'public' ELSE 'private' END AS "vehicleType"
  FROM step),
traffic_data AS (
  SELECT 't' || CAST(event_id AS VARCHAR) AS id, vehicle_id,
         'cam-' || CAST(event_id % 7 AS VARCHAR) AS camera_id, lat, lon, timestamp,
         'Base64EncodedString' AS snapshot
  FROM step),
weather_data AS (
  SELECT 'w' || CAST(event_id AS VARCHAR) AS id, vehicle_id, lat, lon, timestamp,
         CAST(event_id % 32 - 5 AS DOUBLE) AS temperature,
         CASE event_id % 4 WHEN 0 THEN 'Sunny' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Rain'
              ELSE 'Snow' END AS "weatherCondition",
         CAST(event_id % 26 AS DOUBLE) AS precipitation,
         CAST(event_id % 101 AS DOUBLE) AS "windSpeed",
         CAST(event_id % 101 AS INTEGER) AS humidity, value AS "airQualityIndex"
  FROM step),
emergency_data AS (
  SELECT 'e' || CAST(event_id AS VARCHAR) AS id, vehicle_id,
         'i' || CAST(event_id AS VARCHAR) AS "incidentId",
         CASE event_id % 5 WHEN 0 THEN 'Accident' WHEN 1 THEN 'Fire' WHEN 2 THEN 'Medical'
              WHEN 3 THEN 'Police' ELSE 'None' END AS type,
         timestamp, lat, lon,
         CASE event_id % 2 WHEN 0 THEN 'Active' ELSE 'Resolved' END AS status,
         'Description of the incident' AS description
  FROM step)
"""

_ARRIVALS = """
SELECT vehicle_id, min(timestamp) AS arrival FROM vehicle_data
WHERE lat >= 52.4862 AND lon <= -1.8904 GROUP BY vehicle_id
"""

_DENSITY = """
SELECT CAST(floor(v.lat / 0.05) AS BIGINT) AS cell_lat, CAST(floor(v.lon / 0.05) AS BIGINT) AS cell_lon,
       count(*) AS n_points
FROM gps_data g JOIN vehicle_data v ON g.vehicle_id = v.vehicle_id AND g.timestamp = v.timestamp GROUP BY 1, 2
"""

_EMERGENCY_SERIES = """
SELECT date_trunc('hour', timestamp) AS bucket_start, count(*) AS n_records,
       CAST(count(*) FILTER (WHERE type <> 'None') AS BIGINT) AS n_incidents
FROM emergency_data GROUP BY 1
"""

# Lateness by a plain running maximum over each partition; offsets as the log assigns them.
_LATE = """
SELECT id, source_partition, source_offset,
       CAST(timestamp < max(timestamp) OVER (PARTITION BY source_partition ORDER BY source_offset)
            - INTERVAL 2 MINUTES AS INTEGER) AS late
FROM (SELECT 'e' || CAST(event_id AS VARCHAR) AS id, timestamp,
             CAST(event_id % 4 AS INTEGER) AS source_partition,
             CAST((event_id // 4 // 8) * 8 + 7 - (event_id // 4) % 8 AS BIGINT) AS source_offset
      FROM step)
"""

# The GPS message as its producer writes it, and what each of the ways to damage it leaves.
_GPS_TEXT = """
SELECT s.event_id, s.event_id % 23 AS d, g.id, g.vehicle_id, g.timestamp, g.speed,
       '"vehicle_id":"' || g.vehicle_id || '",' AS vehicle,
       '"timestamp":"' || strftime(g.timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '",' AS clock,
       '"speed":' || CAST(g.speed AS VARCHAR) || ',' AS pace,
       '"direction":"North-East","vehicleType":"' || g."vehicleType" || '"}' AS rest
FROM step s JOIN gps_data g ON g.id = 'g' || CAST(s.event_id AS VARCHAR)
"""

_DAMAGED = f"""
SELECT event_id, CAST(d AS INTEGER) AS damage,
       CASE WHEN d IN (0, 1, 2, 3, 5, 6, 7, 8, 10, 21, 22) THEN id
            WHEN d = 4 THEN '7' WHEN d = 11 THEN '{{"a":1}}' END AS id,
       CASE WHEN d IN (0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 20, 21, 22) THEN vehicle_id END AS vehicle_id,
       CASE WHEN d IN (0, 1, 2, 3, 4, 5, 9, 10, 11, 20, 21, 22) THEN timestamp
            WHEN d = 7 THEN TIMESTAMP '2024-01-01 00:00:00'
            WHEN d = 8 THEN timestamp - INTERVAL 2 HOURS END AS timestamp,
       CASE WHEN d IN (0, 2, 4, 6, 7, 8, 9, 10, 11, 20, 21, 22) THEN speed
            WHEN d = 5 THEN CAST('NaN' AS DOUBLE) END AS speed,
       CASE WHEN d IN (16, 17, 18) THEN 'empty' WHEN d IN (9, 19, 20) THEN 'keyless'
            WHEN d IN (3, 6, 12, 13, 14, 15, 21, 22) THEN 'malformed' END AS problem
FROM ({_GPS_TEXT})
"""

_QUARANTINE = f"""
SELECT event_id,
       CASE d WHEN 3 THEN head || vehicle || clock || '"speed":"' || CAST(speed AS VARCHAR) || '",' || rest
              WHEN 6 THEN head || vehicle || '"timestamp":"yesterday",' || pace || rest
              WHEN 9 THEN '{{"ID":"' || id || '",' || vehicle || clock || pace || rest
              WHEN 12 THEN substr(whole, 1, 40)
              WHEN 13 THEN 'hello ' || id
              WHEN 14 THEN 'null'
              WHEN 15 THEN '[' || whole || ']'
              WHEN 16 THEN ''
              WHEN 18 THEN chr(10) || chr(9) || ' '
              WHEN 19 THEN '{{}}'
              WHEN 20 THEN '{{"id":null,' || vehicle || clock || pace || rest
              WHEN 21 THEN whole || ' trailing'
              WHEN 22 THEN whole || whole END AS value,
       CASE WHEN d IN (16, 17, 18) THEN 'empty' WHEN d IN (9, 19, 20) THEN 'keyless'
            ELSE 'malformed' END AS problem
FROM (SELECT *, head || vehicle || clock || pace || rest AS whole
      FROM (SELECT *, '{{"id":"' || id || '",' AS head FROM ({_GPS_TEXT})))
WHERE d IN (3, 6, 9, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22)
"""

# The declared columns, as rows of (topic, ordinal, name, type).
_DECLARED = """
    ('vehicle_data', 1, 'id', 'string'), ('vehicle_data', 2, 'vehicle_id', 'string'),
    ('vehicle_data', 3, 'timestamp', 'timestamp'), ('vehicle_data', 4, 'location', 'string'),
    ('vehicle_data', 5, 'speed', 'double'), ('vehicle_data', 6, 'direction', 'string'),
    ('vehicle_data', 7, 'make', 'string'), ('vehicle_data', 8, 'model', 'string'),
    ('vehicle_data', 9, 'year', 'int'), ('vehicle_data', 10, 'fuelType', 'string'),
    ('gps_data', 1, 'id', 'string'), ('gps_data', 2, 'vehicle_id', 'string'),
    ('gps_data', 3, 'timestamp', 'timestamp'), ('gps_data', 4, 'speed', 'double'),
    ('gps_data', 5, 'direction', 'string'), ('gps_data', 6, 'vehicleType', 'string'),
    ('traffic_data', 1, 'id', 'string'), ('traffic_data', 2, 'vehicle_id', 'string'),
    ('traffic_data', 3, 'camera_id', 'string'), ('traffic_data', 4, 'location', 'string'),
    ('traffic_data', 5, 'timestamp', 'timestamp'), ('traffic_data', 6, 'snapshot', 'string'),
    ('weather_data', 1, 'id', 'string'), ('weather_data', 2, 'vehicle_id', 'string'),
    ('weather_data', 3, 'location', 'string'), ('weather_data', 4, 'timestamp', 'timestamp'),
    ('weather_data', 5, 'temperature', 'double'), ('weather_data', 6, 'weatherCondition', 'string'),
    ('weather_data', 7, 'precipitation', 'double'), ('weather_data', 8, 'windSpeed', 'double'),
    ('weather_data', 9, 'humidity', 'int'), ('weather_data', 10, 'airQualityIndex', 'double'),
    ('emergency_data', 1, 'id', 'string'), ('emergency_data', 2, 'vehicle_id', 'string'),
    ('emergency_data', 3, 'incidentId', 'string'), ('emergency_data', 4, 'type', 'string'),
    ('emergency_data', 5, 'timestamp', 'timestamp'), ('emergency_data', 6, 'location', 'string'),
    ('emergency_data', 7, 'status', 'string'), ('emergency_data', 8, 'description', 'string')
"""

# Columns of each topic's rows; "place" stands for the location's text and its two numbers.
_PLACE = "'[' || CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) || ']' AS location, lat, lon"
_ROWS = {
    VEHICLE: f'id, vehicle_id, timestamp, {_PLACE}, speed, direction, make, model, year, "fuelType"',
    GPS: 'id, vehicle_id, timestamp, speed, direction, "vehicleType"',
    TRAFFIC: f"id, vehicle_id, camera_id, {_PLACE}, timestamp, snapshot",
    WEATHER: (
        f'id, vehicle_id, {_PLACE}, timestamp, temperature, "weatherCondition", precipitation, '
        '"windSpeed", humidity, "airQualityIndex"'
    ),
    EMERGENCY: f'id, vehicle_id, "incidentId", type, timestamp, {_PLACE}, status, description',
}


def _topic_rows(topic: str) -> str:
    return f"SELECT {_ROWS[topic]} FROM {topic}"


def _each_topic(select: str) -> str:
    return " UNION ALL ".join(select.format(topic=t) for t in TOPICS)


def _columns(select: str) -> str:
    counts = _each_topic("SELECT '{topic}' AS topic, count(*) AS n FROM {topic}")
    return f"{select} FROM (VALUES {_DECLARED}) d(topic, ordinal, name, type) JOIN ({counts}) c USING (topic)"


def _share(topic: str, column: str) -> str:
    return (
        f'SELECT "{column}" AS category, count(*) AS n_rows, '
        f"round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM {topic}), 6) AS share "
        f"FROM {topic} GROUP BY 1"
    )


def _outside(topic: str, field: str, low: int, high: int) -> str:
    return (
        f"SELECT '{topic}' AS topic, '{field}' AS field, "
        f'CAST(count(*) FILTER (WHERE "{field}" < {low}) AS BIGINT) AS n_below, '
        f'CAST(count(*) FILTER (WHERE "{field}" > {high}) AS BIGINT) AS n_above FROM {topic}'
    )


_RANGES = (
    (VEHICLE, "speed", 10, 40),
    (GPS, "speed", 0, 40),
    (WEATHER, "temperature", -5, 26),
    (WEATHER, "precipitation", 0, 25),
    (WEATHER, "windSpeed", 0, 100),
    (WEATHER, "humidity", 0, 100),
    (WEATHER, "airQualityIndex", 0, 500),
)


def all_oracles() -> dict[str, str]:
    on_topics = {
        "schema_catalog": _columns(
            "SELECT topic, ordinal, name AS column_name, type AS data_type, n AS n_values"
        ),
        **{f"decode_stream_{t}": _topic_rows(t) for t in TOPICS},
        "decode_edge_cases": _DAMAGED,
        "late_rows_kept": f"SELECT id, vehicle_id, timestamp, type, status FROM {EMERGENCY}",
        "series_emergency_stream": (
            f"SELECT * FROM ({_EMERGENCY_SERIES}) WHERE bucket_start + INTERVAL 1 HOUR "
            "<= (SELECT max(timestamp) - INTERVAL 2 MINUTES FROM emergency_data)"
        ),
        "series_emergency_live": _EMERGENCY_SERIES,
        **{f"land_{t}": _topic_rows(t) for t in TOPICS},
        "resume_no_duplicates": _topic_rows(GPS),
        "land_all_topics": _each_topic(
            "SELECT '{topic}' AS topic, count(*) AS n_rows, min(timestamp) AS first_time, "
            "max(timestamp) AS last_time FROM {topic}"
        ),
        "fanout_counts": _each_topic(
            "SELECT '{topic}' AS topic, count(*) AS n_records, min(timestamp) AS first_time, "
            "max(timestamp) AS last_time FROM {topic}"
        ),
        "json_roundtrip": _topic_rows(WEATHER),
        "envelope": _each_topic(
            "SELECT id AS message_key, '{topic}' AS topic, id, vehicle_id, timestamp FROM {topic}"
        ),
        "delivery_report": _each_topic(
            "SELECT '{topic}' AS topic, count(*) AS n_messages, 0::BIGINT AS n_keyless, 0::BIGINT AS bytes_apart "
            "FROM {topic}"
        ),
        "first_arrival": _ARRIVALS,
        "trim_at_arrival": (
            f"SELECT v.id, v.vehicle_id, v.timestamp FROM vehicle_data v LEFT JOIN ({_ARRIVALS}) a "
            "ON v.vehicle_id = a.vehicle_id WHERE a.arrival IS NULL OR v.timestamp < a.arrival"
        ),
        "entries_per_table": _each_topic(
            "SELECT '{topic}' AS table_name, count(*) AS n_rows FROM {topic}"
        ),
        "avg_speed": "SELECT round(avg(speed), 6) AS avg_speed FROM vehicle_data",
        "avg_speed_by_vehicle": (
            "SELECT vehicle_id, round(avg(speed), 6) AS avg_speed FROM vehicle_data GROUP BY 1"
        ),
        "incident_count": (
            "SELECT count(*) AS n_records, "
            "CAST(count(*) FILTER (WHERE type <> 'None') AS BIGINT) AS n_incidents "
            "FROM emergency_data"
        ),
        "series_vehicle": (
            "SELECT date_trunc('hour', timestamp) AS bucket_start, count(*) AS n_records, "
            "round(avg(speed), 6) AS avg_speed FROM vehicle_data GROUP BY 1"
        ),
        "series_weather": (
            "SELECT date_trunc('hour', timestamp) AS bucket_start, count(*) AS n_records, "
            "round(avg(temperature), 6) AS avg_temperature, "
            "round(avg(precipitation), 6) AS avg_precipitation, "
            'round(avg("windSpeed"), 6) AS "avg_windSpeed", '
            "round(avg(humidity), 6) AS avg_humidity, "
            'round(avg("airQualityIndex"), 6) AS "avg_airQualityIndex" '
            "FROM weather_data GROUP BY 1"
        ),
        "series_emergency": _EMERGENCY_SERIES,
        "vehicle_route": (
            "SELECT vehicle_id, CAST(row_number() OVER (PARTITION BY vehicle_id "
            "ORDER BY timestamp, id) AS BIGINT) AS seq, timestamp, id, lat, lon FROM vehicle_data"
        ),
        "latest_position": (
            "SELECT vehicle_id, timestamp, lat, lon FROM (SELECT *, row_number() OVER ("
            "PARTITION BY vehicle_id ORDER BY timestamp DESC, id DESC) AS n FROM vehicle_data) "
            "WHERE n = 1"
        ),
        "gps_density": _DENSITY,
        "gps_density_bucketed": _DENSITY,
        "share_weather": _share(WEATHER, "weatherCondition"),
        "share_incident_type": _share(EMERGENCY, "type"),
        "share_incident_status": _share(EMERGENCY, "status"),
        "share_vehicle_type": _share(GPS, "vehicleType"),
        "share_fuel": _share(VEHICLE, "fuelType"),
        "detail_fastest": (
            "SELECT id, vehicle_id, timestamp, speed, make, year FROM vehicle_data "
            "WHERE \"fuelType\" = 'Electric' ORDER BY speed DESC, id LIMIT 20"
        ),
        "catalog_columns": _columns(
            "SELECT topic AS table_name, name AS column_name, type AS data_type, n AS n_rows"
        ),
        "sql_adhoc": (
            "SELECT make, year, count(*) AS n_rows, "
            "CAST(count(*) FILTER (WHERE \"fuelType\" = 'Electric') AS BIGINT) AS n_fuel, "
            "max(speed) AS top_speed FROM vehicle_data WHERE speed >= 20 GROUP BY make, year"
        ),
        "parse_position": f"SELECT id, camera_id, lat, lon FROM {TRAFFIC}",
        "quarantine": _QUARANTINE,
        "checked_sound": f"SELECT id, vehicle_id, timestamp, speed FROM ({_DAMAGED}) WHERE problem IS NULL",
        "dedup_by_id": (
            f"SELECT * FROM ({_topic_rows(GPS)}) WHERE CAST(substr(id, 2) AS BIGINT) % 17 <> 0 "
            f"UNION ALL SELECT NULL AS id, g.* EXCLUDE (id, copy) FROM "
            f"(SELECT *, unnest(range(CASE WHEN CAST(substr(id, 2) AS BIGINT) % 10 = 0 THEN 12 ELSE 2 END)) "
            f"AS copy FROM ({_topic_rows(GPS)}) WHERE CAST(substr(id, 2) AS BIGINT) % 17 = 0) g"
        ),
        "dedup_days_apart": (
            f"SELECT * FROM ({_topic_rows(GPS)}) WHERE CAST(substr(id, 2) AS BIGINT) % 17 <> 0 "
            f"UNION ALL SELECT NULL AS id, g.* EXCLUDE (id, copy) FROM "
            f"(SELECT *, unnest(range(CASE WHEN CAST(substr(id, 2) AS BIGINT) % 3 = 1 THEN 3 ELSE 2 END)) "
            f"AS copy FROM ({_topic_rows(GPS)}) WHERE CAST(substr(id, 2) AS BIGINT) % 17 = 0) g"
        ),
        "late_rows": _LATE,
        "late_rows_stream": _LATE,
        "range_violations": " UNION ALL ".join(_outside(*r) for r in _RANGES),
        "gps_position_stream": (
            "SELECT g.id, g.vehicle_id, g.timestamp, g.speed, v.lat, v.lon "
            "FROM gps_data g JOIN vehicle_data v "
            "ON g.vehicle_id = v.vehicle_id AND g.timestamp = v.timestamp"
        ),
    }
    return {name: _TOPICS + text for name, text in on_topics.items()}
