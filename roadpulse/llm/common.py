"""What several operators share: reading tables, folds by id, the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def labelled(labels: DataFrame, column: str) -> DataFrame:
    """One row per labelled doc_id; where rows disagree the smaller mark counts, nulls do not."""
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(column).alias("mark"))
    )


def first_by_hash(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, the same at every run: those of smallest hash of doc_id.

    A bounded sample for fitting; its size is what makes it safe to broadcast. The count of rows tells
    how small a hash has to be, so that only about as many rows as are wanted get sorted.
    """
    place = id_hash()
    few = ids.filter(place < hash_limit(most, ids.count()))
    return few.orderBy(place, "doc_id").limit(most)


def id_hash() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def hash_limit(most: int, n: int | Column) -> Column:
    """A limit of `id_hash` below which ``most`` of n rows lie, with room for chance."""
    share = F.lit(1.1 * most + 100) / F.greatest(F.lit(n) if isinstance(n, int) else n, F.lit(1))
    return F.least(share, F.lit(1.0)) * 2.0**32


_shipped: set[str] = set()

#: Rows that travel to a Python worker at a time; whole texts make long rows.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give the workers this package, as --py-files would, once for each application; and see that batches
    of whole texts stay small."""
    context = spark.sparkContext
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="roadpulse-code-")  # of the driver, which serves it
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        top, name = os.path.split(package)
        context.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", top, name))
        _shipped.add(context.applicationId)
