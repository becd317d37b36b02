"""Vehicle telemetry ingestion and fleet analytics on Spark."""

from roadpulse.options import Options
from roadpulse.schemas import TOPICS, get_schema

__all__ = ["Options", "TOPICS", "get_schema"]
