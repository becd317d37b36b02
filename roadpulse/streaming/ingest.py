"""One independent ingestion query per topic, and their common life."""

from __future__ import annotations

import signal
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roadpulse.operators.decode import decode, with_event_time
from roadpulse.options import Options
from roadpulse.schemas import TOPICS, get_schema
from roadpulse.sources import kafka
from roadpulse.streaming.sinks import land

# Gives a topic's stream of messages.
Source = Callable[[str], DataFrame]


def ingest(
    messages: DataFrame, topic: str, options: Options, columns: Sequence[str] | None = None
) -> DataFrame:
    """Messages to typed rows with an event time; ``columns`` decodes only these."""
    return with_event_time(decode(messages, topic, columns), options.watermark_delay)


def start_all(
    spark: SparkSession,
    options: Options,
    topics: Sequence[str] = TOPICS,
    source: Source | None = None,
) -> list[StreamingQuery]:
    """Start landing every topic. All topics are checked first; if one fails to start, those
    already running are stopped."""
    for topic in topics:
        get_schema(topic)
    source = source or (lambda topic: kafka.read_topic(spark, topic, options))
    started: list[StreamingQuery] = []
    try:
        for topic in topics:
            started.append(land(ingest(source(topic), topic, options), topic, options))
    except Exception:
        stop_all(started)
        raise
    return started


def stop_all(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()


def supervise(
    queries: Sequence[StreamingQuery],
    stop: threading.Event | None = None,
    poll_seconds: float = 0.2,
) -> None:
    """Wait until all queries have ended, or ``stop`` is set and they have been stopped.

    The first query to fail, whichever it is, stops the others, and its error is raised.
    """
    try:
        while stop is None or not stop.is_set():
            for query in queries:
                error = query.exception()
                if error is not None:
                    raise error
            active = [q for q in queries if q.isActive]
            if not active:
                return
            active[0].awaitTermination(poll_seconds)
        stop_all(queries)
    except BaseException:
        stop_all(queries)
        raise


def run(query: StreamingQuery) -> None:
    """Wait for a query that ends by itself."""
    supervise([query])


def install_stop_handlers() -> threading.Event:
    """An event that SIGINT and SIGTERM set, for `supervise`.

    The handler itself does not stop the queries: it may interrupt a call to the JVM half way, and
    the connection takes one call at a time.
    """
    stop = threading.Event()

    def handler(signum, frame):
        stop.set()

    signal.signal(signal.SIGINT, handler)
    signal.signal(signal.SIGTERM, handler)
    return stop
