"""One options object shared by the producer side, the ingestion job and the analytics."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from roadpulse.schemas import EMERGENCY, GPS, TOPICS, TRAFFIC, VEHICLE, WEATHER

# Environment variables that rename a topic or the broker, and their defaults.
SERVERS_VARIABLE = "KAFKA_BOOTSTRAP_SERVERS"
DEFAULT_SERVERS = "localhost:9092"
TOPIC_VARIABLES = {
    VEHICLE: "VEHICLE_TOPIC",
    GPS: "GPS_TOPIC",
    TRAFFIC: "TRAFFIC_TOPIC",
    WEATHER: "WEATHER_TOPIC",
    EMERGENCY: "EMERGENCY_TOPIC",
}


@dataclass(frozen=True)
class Options:
    """Where records come from, where they land, and how the streams are driven.

    ``base_uri`` is any Hadoop URI (``file:``, ``hdfs:``, ``s3a:``). Credentials never pass
    through here; they come from the file system's own provider chain.
    """

    base_uri: str = ""
    servers: str = DEFAULT_SERVERS
    topic_names: Mapping[str, str] = field(default_factory=lambda: {t: t for t in TOPICS})
    watermark_delay: str = "2 minutes"
    starting_offsets: str = "earliest"
    # None: micro-batches back to back. "available": all present input, then stop.
    # Anything else is a processing-time interval such as "1 minute".
    trigger: str | None = None
    # Splits a hot Kafka partition over several tasks; None keeps one task per partition.
    min_partitions: int | None = None
    max_offsets_per_trigger: int | None = None
    max_files_per_trigger: int | None = None
    # A file source forgets files older than this, counted back from the newest it has seen, and
    # would skip those it has yet to read. Far enough back that none is.
    max_file_age: str = "36500d"
    # Landed tables partitioned by event date, for partition pruning.
    partition_by_date: bool = False

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **overrides) -> Options:
        env = os.environ if env is None else env
        names = {topic: env.get(variable, topic) for topic, variable in TOPIC_VARIABLES.items()}
        servers = env.get(SERVERS_VARIABLE, DEFAULT_SERVERS)
        return cls(**{"servers": servers, "topic_names": names, **overrides})

    def with_(self, **changes) -> Options:
        return replace(self, **changes)

    def topic_name(self, topic: str) -> str:
        """Name of a record kind's topic on the broker."""
        return self.topic_names[topic]

    def data_path(self, topic: str) -> str:
        return self._under("data", topic)

    def checkpoint_path(self, topic: str) -> str:
        return self._under("checkpoints", topic)

    def _under(self, folder: str, topic: str) -> str:
        if not self.base_uri:
            raise ValueError("base_uri is not set")
        return f"{self.base_uri.rstrip('/')}/{folder}/{topic}"
