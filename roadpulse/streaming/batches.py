"""Tables that a stream writes micro-batch by micro-batch, so that a batch run again changes nothing.

The engine repeats the batch that was under way when a query ended. Its rows therefore go to a folder of the batch's
number, which is replaced as a whole: as one more part of a table, or as the table's next state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType

from roadpulse.operators.decode import decode_checked
from roadpulse.operators.quality import ORIGIN_KEY, late_rows
from roadpulse.operators.running import CHUNK
from roadpulse.operators.series import WIDTH, series
from roadpulse.schemas import EVENT_TIME, get_schema
from roadpulse.sources.files import matching, remove, side_by_side
from roadpulse.streaming.sinks import with_trigger

BATCH, OUTCOME = "batch", "outcome"
SOUND, QUARANTINED = "sound", "quarantined"


def write_batch(df: DataFrame, base: str, number: int, partition_by: Sequence[str] = ()) -> None:
    with side_by_side(df.sparkSession) as options:
        df.write.mode("overwrite").options(**options).partitionBy(*partition_by).parquet(f"{base}/{BATCH}={number}")


def whole_batches(spark: SparkSession, base: str) -> dict[int, str]:
    """Number and folder of the batches that were written whole."""
    folders = [path.removesuffix("/_SUCCESS") for path in matching(spark, f"{base}/{BATCH}=*/_SUCCESS")]
    return {int(folder.rpartition("=")[2]): folder for folder in folders}


def read_batches(
    spark: SparkSession, base: str, schema: StructType, after: int = -1, before: int | None = None
) -> DataFrame:
    """Rows of the batches that were written whole, if need be only of those numbered between two others; ``schema``
    includes the columns they are partitioned by."""
    found = whole_batches(spark, base).items()
    whole = [folder for n, folder in found if n > after and (before is None or n < before)]
    if not whole:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*whole).select(*schema.names)


def read_batch(spark: SparkSession, base: str, number: int, schema: StructType) -> DataFrame:
    """Rows of one batch, none if it was not written whole."""
    path = f"{base}/{BATCH}={number}"
    if not matching(spark, f"{path}/_SUCCESS"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _checked(messages: DataFrame, topic: str, *keep: str) -> DataFrame:
    """Decoded rows with their outcome; the text is kept of bad messages only."""
    bad = F.col("problem").isNotNull()
    return (
        decode_checked(messages, topic, *keep)
        .withColumn("value", F.when(bad, F.col("value")))
        .withColumn(OUTCOME, F.when(bad, QUARANTINED).otherwise(SOUND))
    )


def land_checked(
    messages: DataFrame, topic: str, base: str, *keep: str, trigger: str | None = None
) -> StreamingQuery:
    """Start landing a topic's sound rows and its bad messages as two tables under ``base``.

    One query reads and decodes each message once and has one checkpoint, so that the two tables cannot part. A
    micro-batch is one job that writes both; until all of it is there, `read_checked` shows none of it.
    """

    def write(batch: DataFrame, number: int) -> None:
        write_batch(batch, f"{base}/data", number, [OUTCOME])

    writer = (
        _checked(messages, topic, *keep)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{base}/checkpoint")
        .queryName(f"{topic}-checked")
    )
    return with_trigger(writer, trigger).start()


def read_checked(spark: SparkSession, topic: str, base: str, keep: str = "") -> tuple[DataFrame, DataFrame]:
    """Sound rows, and bad messages with their text and problem. ``keep`` are the kept columns with their types."""
    kept = StructType.fromDDL(keep) if keep else StructType([])
    fields = [*kept.fields, *get_schema(topic).fields]
    schema = StructType([*fields, *StructType.fromDDL(f"value STRING, problem STRING, {OUTCOME} STRING").fields])
    rows = read_batches(spark, f"{base}/data", schema)
    sound = rows.where(F.col(OUTCOME) == SOUND).select(*get_schema(topic).names)
    return sound, rows.where(F.col(OUTCOME) == QUARANTINED).select(*kept.names, "value", "problem")


def land_late(
    decoded: DataFrame, base: str, delay: str = "2 minutes", chunk: int = CHUNK, trigger: str | None = None
) -> StreamingQuery:
    """Start landing rows decoded with their origin, each labelled ``late`` or not as `late_rows` does.

    The state between batches is one row per topic partition, the latest time seen; within a batch, a busy
    partition is cut into chunks of offsets. Batches must bring the offsets of a partition in order, as a broker's do.
    Where they begin and end does not show in the labels.
    """
    spark = decoded.sparkSession
    state = StructType([*(decoded.schema[c] for c in ORIGIN_KEY), decoded.schema[EVENT_TIME]])

    def write(batch: DataFrame, number: int) -> None:
        before = read_batch(spark, f"{base}/seen", number - 1, state)
        write_batch(late_rows(batch, delay, chunk, before), f"{base}/data", number)
        rows = read_batch(spark, f"{base}/data", number, decoded.schema).select(*state.names)
        seen = before.unionByName(rows).groupBy(*ORIGIN_KEY).agg(F.max(EVENT_TIME).alias(EVENT_TIME))
        write_batch(seen, f"{base}/seen", number)

    writer = decoded.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
    return with_trigger(writer, trigger).start()


def read_late(spark: SparkSession, decoded: DataFrame, base: str) -> DataFrame:
    """What `land_late` has landed of such rows."""
    return read_batches(spark, f"{base}/data", StructType([*decoded.schema.fields, *StructType.fromDDL("late BOOLEAN").fields]))


#: A series has few rows; so many files are enough for each of its states, of which the last ones are kept.
SERIES_FILES, STATES = 4, 3


def land_series(
    decoded: DataFrame,
    measures: Sequence[Column],
    base: str,
    width: str = WIDTH,
    delay: str | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Start keeping a table of measures per time bucket that includes the buckets still open.

    Takes the stream before its watermark is declared. After each micro-batch the table equals the batch `series`
    over all rows so far: a batch gives the buckets it has changed, which replace those of the table before it. Without
    ``delay`` every row counts, however late, and state has one row per bucket; with it, state ends with
    the watermark, and rows behind that are left out.
    """
    spark = decoded.sparkSession
    rows = decoded if delay is None else decoded.withWatermark(EVENT_TIME, delay)
    # Rows without event time are in no bucket.
    changed = series(rows.where(F.col(EVENT_TIME).isNotNull()), measures, width)
    schema = StructType([StructField(f.name, f.dataType) for f in changed.schema.fields])

    def write(batch: DataFrame, number: int) -> None:
        before = read_batch(spark, f"{base}/data", number - 1, schema)
        # Both are as small as the table; that of the batch is read twice, so it is written before.
        write_batch(batch.coalesce(SERIES_FILES), f"{base}/changed", number)
        new = read_batch(spark, f"{base}/changed", number, schema)
        kept = before.join(new.select("bucket_start"), "bucket_start", "left_anti")
        write_batch(kept.unionByName(new).coalesce(SERIES_FILES), f"{base}/data", number)
        for folder in ("data", "changed"):
            remove(spark, f"{base}/{folder}/{BATCH}={number - STATES}")

    writer = (
        changed.writeStream.foreachBatch(write)
        .outputMode("update")
        .option("checkpointLocation", f"{base}/checkpoint")
    )
    return with_trigger(writer, trigger).start()


def read_series(spark: SparkSession, decoded: DataFrame, measures: Sequence[Column], base: str, width: str = WIDTH) -> DataFrame:
    """The table that `land_series` keeps of such rows, as its last whole state has it."""
    schema = series(decoded, measures, width).schema
    return read_batch(spark, f"{base}/data", max(whole_batches(spark, f"{base}/data"), default=-1), schema)
