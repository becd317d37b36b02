"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

APP_NAME = "roadpulse"

# Passed to spark-submit as --packages; never fetched by the library. Must match Spark and Scala.
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_scratch: dict[str, str] = {}


def session_options(rocksdb: bool = False) -> dict[str, str]:
    """Settings every job wants, whatever the cluster."""
    options = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Static-key settings are left out on purpose: object stores use their provider chain.
    }
    if rocksdb:
        options["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB_PROVIDER
    return options


def create_session(
    master: str | None = None,
    app_name: str = APP_NAME,
    rocksdb: bool = False,
    log_level: str = "WARN",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**session_options(rocksdb), **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Zone-less timestamps are read in the session zone, so results need it fixed."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder shared by driver and executors that the cluster names in spark.checkpoint.dir.

    Only a local-mode session may go without the setting, or name a folder of one machine; its own
    folder is removed when the process ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    local = context.master.startswith("local")
    if shared and (local or not shared.startswith("file:")):
        return shared.rstrip("/")
    if not local:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="roadpulse-")
        atexit.register(shutil.rmtree, _local_scratch[app], ignore_errors=True)
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nothing has written to yet."""
    return f"{scratch_root(spark)}/roadpulse/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a result to the shared folder once and read it back.

    Later stages then start from files: a lost executor costs a re-read, not a re-computation,
    and the planner sees the table's true size when it picks a join.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def materialized_for(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The same for a large table that is of use for a short time only: its folder goes at the end."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
