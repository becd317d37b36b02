"""Message logs kept as files: a source with the broker's columns for when there is no broker."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.options import Options
from roadpulse.schemas import get_schema

MESSAGE_DDL = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, "
    "timestampType INT"
)
_COLUMNS = ("key", "value", "partition", "offset", "timestamp", "timestampType")


#: A task keeps the files of so many partitions open at once, each with a row group of so many bytes in memory.
OPEN_FILES, ROW_GROUP = 16, 16 * 2**20
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[dict[str, int]]:
    """Within it, a writer partitioned by few values writes their files side by side; takes the writer's options.

    By default a task sorts its rows by partition first, and what it sorts grows with its share of the input. Only rows
    of more than OPEN_FILES values are still sorted. A streaming query keeps the setting it was started with.
    """
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, OPEN_FILES)
    try:
        yield {"parquet.block.size": ROW_GROUP}
    finally:
        spark.conf.set(_WRITERS, before)


def write_log(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Append messages to a log, one folder per topic."""
    with side_by_side(messages.sparkSession) as options:
        messages.write.mode(mode).options(**options).partitionBy("topic").parquet(path)


def read_log_topic(
    spark: SparkSession, path: str, topic: str, options: Options | None = None
) -> DataFrame:
    """Stream of one topic of a log. The first run reads all files present, whatever their age."""
    get_schema(topic)
    options = options or Options()
    name = options.topic_name(topic)
    reader = spark.readStream.schema(
        ", ".join(f for f in MESSAGE_DDL.split(", ") if not f.startswith("topic "))
    ).option("maxFileAge", options.max_file_age)
    if options.max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", options.max_files_per_trigger)
    return reader.parquet(f"{path}/topic={name}").withColumn("topic", F.lit(name))


def _at(spark: SparkSession, path: str):
    """A path and the file system it is on."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def same_place(spark: SparkSession, one: str, other: str) -> bool:
    """Whether two paths name the same folder, with or without a scheme."""
    full = [str(files.makeQualified(target)) for files, target in (_at(spark, one), _at(spark, other))]
    return full[0].rstrip("/") == full[1].rstrip("/")


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths of the files and folders that a pattern names, in order."""
    files, target = _at(spark, pattern)
    return sorted(str(status.getPath()) for status in files.globStatus(target) or ())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder with all in it, if there is one."""
    files, target = _at(spark, path)
    files.delete(target, True)


def modified(spark: SparkSession, path: str) -> int:
    """When a file or folder was last changed."""
    files, target = _at(spark, path)
    return files.getFileStatus(target).getModificationTime()


def table_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files under a folder."""
    files, target = _at(spark, path)
    return files.getContentSummary(target).getLength()


def stream_table(spark: SparkSession, folder: str, name: str, **options: str | int) -> DataFrame:
    """One table of a folder as a stream, be it a single Parquet file or a folder of them; ``options``
    of the file source say how much a micro-batch takes."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFileAge", Options().max_file_age).options(**options)
    files, target = _at(spark, path)
    if files.getFileStatus(target).isDirectory():
        return reader.parquet(path)
    # A file stream wants a folder; naming the file itself fails when the query runs.
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)
