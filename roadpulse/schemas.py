"""The five record kinds and their declared schemas."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

VEHICLE = "vehicle_data"
GPS = "gps_data"
TRAFFIC = "traffic_data"
WEATHER = "weather_data"
EMERGENCY = "emergency_data"

TOPICS = (VEHICLE, GPS, TRAFFIC, WEATHER, EMERGENCY)

EVENT_TIME = "timestamp"
# Partition column of tables landed by date; no record has it.
DATE_COLUMN = "event_date"
STEP_KEY = ("vehicle_id", "timestamp")

_STRING, _TIME, _DOUBLE, _INT = StringType(), TimestampType(), DoubleType(), IntegerType()

# Field names, order and types of each record kind.
_FIELDS = {
    VEHICLE: [
        ("id", _STRING),
        ("vehicle_id", _STRING),
        ("timestamp", _TIME),
        ("location", _STRING),
        ("speed", _DOUBLE),
        ("direction", _STRING),
        ("make", _STRING),
        ("model", _STRING),
        ("year", _INT),
        ("fuelType", _STRING),
    ],
    GPS: [
        ("id", _STRING),
        ("vehicle_id", _STRING),
        ("timestamp", _TIME),
        ("speed", _DOUBLE),
        ("direction", _STRING),
        ("vehicleType", _STRING),
    ],
    TRAFFIC: [
        ("id", _STRING),
        ("vehicle_id", _STRING),
        ("camera_id", _STRING),
        ("location", _STRING),
        ("timestamp", _TIME),
        ("snapshot", _STRING),
    ],
    WEATHER: [
        ("id", _STRING),
        ("vehicle_id", _STRING),
        ("location", _STRING),
        ("timestamp", _TIME),
        ("temperature", _DOUBLE),
        ("weatherCondition", _STRING),
        ("precipitation", _DOUBLE),
        ("windSpeed", _DOUBLE),
        ("humidity", _INT),
        ("airQualityIndex", _DOUBLE),
    ],
    EMERGENCY: [
        ("id", _STRING),
        ("vehicle_id", _STRING),
        ("incidentId", _STRING),
        ("type", _STRING),
        ("timestamp", _TIME),
        ("location", _STRING),
        ("status", _STRING),
        ("description", _STRING),
    ],
}


def get_schema(topic: str) -> StructType:
    """Declared schema of a topic; an unknown topic is an error, found before any query starts."""
    if topic not in _FIELDS:
        raise ValueError(f"{topic!r} is not one of the record kinds {', '.join(_FIELDS)}")
    return StructType([StructField(name, kind) for name, kind in _FIELDS[topic]])


def has_position(topic: str) -> bool:
    return "location" in get_schema(topic).fieldNames()
