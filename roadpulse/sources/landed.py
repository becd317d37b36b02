"""Landed tables: reading, cataloguing, ad-hoc SQL, compaction."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.options import Options
from roadpulse.schemas import DATE_COLUMN, EVENT_TIME, STEP_KEY, TOPICS, get_schema
from roadpulse.sources.files import same_place, table_bytes


def read_landed(spark: SparkSession, options: Options, topic: str) -> DataFrame:
    """A topic's landed table, read by folder so that the sink's own log decides which files count.

    The declared schema is given, which spares a look at the files and leaves behind the watermark
    mark that a streaming write puts on the event-time column.
    """
    return spark.read.schema(get_schema(topic)).parquet(options.data_path(topic))


def stream_landed(spark: SparkSession, options: Options, topic: str) -> DataFrame:
    """The landed table as a stream, without a watermark: a windowed query that forgets to declare
    one is then refused, where the mark left in the files would let it run and emit nothing."""
    stream = spark.readStream.schema(get_schema(topic)).parquet(options.data_path(topic))
    return stream.withMetadata(EVENT_TIME, {})


def _discovered(spark: SparkSession, options: Options, topic: str) -> DataFrame:
    """The table as its files describe it; the declared schema stands in while there are none."""
    try:
        return spark.read.parquet(options.data_path(topic))
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return read_landed(spark, options, topic)


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return described.where("col_name = 'Location'").first()["data_type"]


def register_tables(
    spark: SparkSession,
    options: Options,
    topics: Sequence[str] = TOPICS,
    database: str | None = None,
) -> list[str]:
    """Make each topic folder a table; columns and types come from the files.

    Temporary views by default; external tables of the catalog where ``database`` is given. A call
    also finds the dates that a table landed by date has got since. A table of that name over
    another folder is an error.
    """
    names = []
    for topic in topics:
        path = options.data_path(topic)
        if database is None:
            _discovered(spark, options, topic).createOrReplaceTempView(topic)
            names.append(topic)
        else:
            name = f"{database}.{topic}"
            if not spark.catalog.tableExists(name):
                spark.catalog.createTable(name, path=path, source="parquet")
            elif not same_place(spark, _location(spark, name), path):
                raise ValueError(f"table {name} is over {_location(spark, name)}, not {path}")
            if any(c.isPartition for c in spark.catalog.listColumns(name)):
                spark.catalog.recoverPartitions(name)
            spark.catalog.refreshTable(name)
            names.append(name)
    return names


def sql(spark: SparkSession, text: str, **args) -> DataFrame:
    """Ad-hoc SQL over the registered tables. Values go in as named parameters, never as text."""
    return spark.sql(text, args=args or None)


def compact(
    spark: SparkSession,
    options: Options,
    topic: str,
    target: str,
    file_bytes: int = 256 * 1024 * 1024,
) -> DataFrame:
    """Rewrite a landed table into fewer, larger files under ``target``, and read it from there.

    Small micro-batches leave small files. Rows are dealt out evenly, not by key, so no vehicle
    makes one file larger than the others. A table partitioned by date stays so: its rows are laid
    out by date and then by where they were read, which cuts a busy date into several files and
    puts quiet ones together in one task.
    """
    table = read_landed(spark, options, topic)
    size = table_bytes(spark, options.data_path(topic))
    parts = max(1, math.ceil(size / file_bytes))
    if options.partition_by_date:
        placed = table.withColumn("_read_at", F.monotonically_increasing_id())
        laid_out = placed.repartitionByRange(parts, DATE_COLUMN, "_read_at").drop("_read_at")
        laid_out.write.partitionBy(DATE_COLUMN).parquet(target)
    else:
        table.repartition(parts).write.parquet(target)
    return spark.read.schema(get_schema(topic)).parquet(target)


def bucketed(
    spark: SparkSession,
    options: Options,
    topic: str,
    table: str,
    target: str,
    buckets: int,
    by: Sequence[str] = STEP_KEY,
) -> DataFrame:
    """Rewrite a landed table as a catalog table of buckets under ``target``, one sorted file each.

    Tables with the same buckets by the same columns are joined, and grouped, by these without an exchange. The step
    of a record is its vehicle and time, so that a busy vehicle lies in all buckets, as if its key were salted; buckets
    by ``vehicle_id`` alone would put it into one. The number of buckets is for good: choose some 256 MB a bucket.
    """
    (
        read_landed(spark, options, topic)
        .repartition(buckets, *by)
        .write.bucketBy(buckets, *by)
        .sortBy(*by)
        .option("path", target)
        .saveAsTable(table)
    )
    return spark.table(table)


def analyze(spark: SparkSession, tables: Sequence[str], columns: Mapping[str, Sequence[str]] | None = None) -> None:
    """Count rows and measure columns of catalog tables, for the cost-based planner (``spark.sql.cbo.enabled``).

    To be called after landing or compaction: statistics do not follow the files. ``columns`` names those of
    a table to be measured; others get distinct counts, nulls and ranges of all columns, in one pass each.
    """
    for table in tables:
        of = (columns or {}).get(table)
        which = "ALL COLUMNS" if of is None else "COLUMNS " + ", ".join(f"`{c}`" for c in of)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR {which}")
