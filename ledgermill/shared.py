"""Tables in the folder that driver and executors share, and checked broadcasts."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

#: Most rows of a few fixed-width columns that are ever broadcast (tens of MB at most).
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master, whose executors are the driver
    itself, gets a folder of our own where that is unset; on a cluster it must be set."""
    found = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.ledgermill.shared", "")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="ledgermill-")
        spark.conf.set("spark.ledgermill.shared", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/ledgermill/{name}-{uuid.uuid4().hex}"


#: Tables saved since alone() began; None outside.
_inner: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("inner", default=None)


def saved(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Writes df as a Parquet table in the shared folder and reads it back: lineage ends there, and a lost
    executor costs no recomputation. The folder's owner removes old tables, as with checkpoints."""
    path = new_path(df.sparkSession, name)
    writer = df.write.mode("error")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._ledgermill_path = path
    if (inner := _inner.get()) is not None:
        inner.append(out)
    return out


def alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """saved(make()), after which the tables that make() saved are removed. Meanwhile shuffle files go when the query that
    wrote them ends, not when the driver happens to collect its garbage."""
    key, inner = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", []
    before, token = spark.conf.get(key), _inner.set(inner)
    spark.conf.set(key, "true")
    try:
        out = saved(make(), name)
    finally:
        spark.conf.set(key, before)
        _inner.reset(token)
    inner.pop()
    dropped(*inner)
    if (outer := _inner.get()) is not None:
        outer.append(out)
    return out


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as its object."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def dropped(*tables: DataFrame) -> None:
    """Removes tables that saved() wrote and nothing reads any more."""
    for df in tables:
        fs, path = file_system(df.sparkSession, df._ledgermill_path)
        fs.delete(path, True)


def renamed(spark: SparkSession, source: str, target: str) -> None:
    """Puts a file or folder in the place of another in one step."""
    fs, a = file_system(spark, source)
    b = fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(target))
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(a), b, options)


def same_place(spark: SparkSession, a: str, b: str) -> bool:
    """Whether two paths, however they are written, name one file or folder, or the first lies inside the second."""
    def resolved(path: str) -> str:
        fs, p = file_system(spark, path)
        whole = fs.makeQualified(p)
        return os.path.realpath(whole.toUri().getPath()) if fs.getUri().getScheme() == "file" else whole.toString().rstrip("/")

    return f"{resolved(a)}/".startswith(f"{resolved(b)}/")


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if df (saved, of narrow rows) has at most so many rows; else df as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Bytes of a batch between the JVM and Python workers; the engine's own default is many times that on either side.
BATCH_BYTES = 8 << 20


def modest_batches(df: DataFrame) -> DataFrame:
    """df, whose session from now on exchanges Arrow batches of BATCH_BYTES at most: memory, not results, depends on it."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", conf.get(key)) or 0) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def released() -> None:
    """Gives memory that a finished task's objects held back to the system; Python workers live on between tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


#: Rows of a narrow table that one task may sort: a few MB.
ONE_TASK_ROWS = 100_000


def running_total(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """df (narrow rows of different `order`) with the sum of value up to each row. A table of at most ONE_TASK_ROWS is one window.
    Of a larger one, range partitions are written once with their numbers and summed, then each takes its start from those
    before: no task sees all rows."""
    rows = saved(df, "running")
    if rows.count() <= ONE_TASK_ROWS:
        return rows.withColumn(name, F.sum(value).over(W.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)).cast("long"))
    parted = saved(rows.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = parted.groupBy("_part").agg(F.sum(value).alias("_sum"))  # a row per partition
    starts = sums.select("_part", (F.sum("_sum").over(W.orderBy("_part")) - F.col("_sum")).alias("_start"))
    inside = F.sum(value).over(W.partitionBy("_part").orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow))
    return parted.withColumn("_inside", inside).join(small(starts), "_part").withColumn(name, (F.col("_inside") + F.col("_start")).cast("long")).drop("_part", "_inside", "_start")
