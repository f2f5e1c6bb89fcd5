"""Session defaults and the shared folder that written tables live in."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "tidemark", **conf: str) -> SparkSession:
    """A session with the settings the library relies on; `conf` overrides them.

    UTC is required (wire timestamps are epoch milliseconds). Keyed streaming
    state goes to RocksDB, so it is bounded by disk and not by executor heap.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A machine-local folder is chosen only for a local master with the setting
    absent; a cluster without it is an error, because files written by one
    executor would be invisible to the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    application = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_DIRS[application]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def constant_rows(spark: SparkSession, rows: Iterable[Sequence], schema: str) -> DataFrame:
    """A few literal rows as a plan of constants, in one task. Times are zone-less."""
    fields = T.StructType.fromDDL(schema).fields

    def constant(value: object, kind: T.DataType) -> Column:
        plain = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else value
        return F.lit(plain).cast(kind)

    values = [
        F.struct(*[constant(v, f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)]) for row in rows
    ]
    one = spark.range(0, 1, 1, 1)
    if not values:
        return one.where("false").select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])
    return one.select(F.inline(F.array(*values)))


@contextmanager
def open_writers(spark: SparkSession, most: int = 16) -> Iterator[None]:
    """Writes by partition keep up to `most` files open in a task; else each task sorts its events by folder first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def whole_payloads(spark: SparkSession) -> Iterator[None]:
    """Variants are written as they are; shredded, each is taken apart by the writer and put together again by a reader of it all."""
    key = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """What a write has shuffled is removed from all executors when it ends, and not when the driver collects its plan.

    For writes only: a frame that is run again would have to shuffle anew.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under `path`; empty when it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it; nothing happens when it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def committed(spark: SparkSession, path: str) -> bool:
    """True when a batch write to `path` has finished (Spark's success marker)."""
    return path_exists(spark, f"{path}/_SUCCESS")
