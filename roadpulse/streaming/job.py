"""The ingestion job: ``python -m roadpulse.streaming.job --base-uri s3a://bucket/telemetry``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from roadpulse.options import Options
from roadpulse.schemas import TOPICS
from roadpulse.session import create_session
from roadpulse.sources.files import read_log_topic
from roadpulse.streaming.ingest import install_stop_handlers, start_all, supervise


def parse(argv: Sequence[str] | None = None) -> tuple[argparse.Namespace, Options]:
    parser = argparse.ArgumentParser(prog="roadpulse-ingest")
    parser.add_argument("--base-uri", required=True, help="folder or bucket that tables land under")
    parser.add_argument("--log", help="read this message log instead of the broker")
    parser.add_argument("--servers", help="broker addresses")
    parser.add_argument("--trigger", help='"available" or an interval such as "1 minute"')
    parser.add_argument("--watermark", default="2 minutes")
    parser.add_argument("--min-partitions", type=int)
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--max-files-per-trigger", type=int)
    parser.add_argument("--partition-by-date", action="store_true")
    parser.add_argument("--rocksdb", action="store_true")
    parser.add_argument("--master")
    args = parser.parse_args(argv)
    given = {
        "base_uri": args.base_uri,
        "trigger": args.trigger,
        "watermark_delay": args.watermark,
        "min_partitions": args.min_partitions,
        "max_offsets_per_trigger": args.max_offsets_per_trigger,
        "max_files_per_trigger": args.max_files_per_trigger,
        "partition_by_date": args.partition_by_date,
    }
    if args.servers:
        given["servers"] = args.servers
    return args, Options.from_env(**given)


def main(argv: Sequence[str] | None = None) -> None:
    args, options = parse(argv)
    spark = create_session(master=args.master, rocksdb=args.rocksdb)
    source = None
    if args.log:
        source = lambda topic: read_log_topic(spark, args.log, topic, options)
    stop = install_stop_handlers()
    supervise(start_all(spark, options, TOPICS, source), stop)
    spark.stop()


if __name__ == "__main__":
    main()
