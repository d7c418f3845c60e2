"""What the operators share: the shared folder, written intermediate tables, safe column names."""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach: the cluster's spark.checkpoint.dir.

    Only a local master may leave it unset; a temporary folder then takes its place.
    """
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("scholarloom.shared.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="scholarloom-")
        spark.conf.set("scholarloom.shared.dir", found)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def run_folder(spark: SparkSession) -> str:
    """This application's folder in the shared one. It goes when the driver's process ends: results are read from it until then."""
    key = "scholarloom.run.dir"
    found = spark.conf.get(key, None)
    if not found:
        found = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
        spark.conf.set(key, found)
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

        def remove() -> None:
            with suppress(Exception):  # the JVM may be gone
                _delete(jvm, conf, found)

        atexit.register(remove)
    return found


def bound_batches(spark: SparkSession, most: str = "4m") -> None:
    """Arrow batches of texts by bytes, not only by rows: their copies on both sides count against an executor's memory.

    The setting is the session's and is read when a result is computed, so it can't be put back here; one other than Spark's own stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) in ("67108864b", "64MB", "67108864"):
        spark.conf.set(key, most)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(jvm, conf, path: str) -> None:
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared store through Spark's own file system layer."""
    _delete(spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path)


class Scratch:
    """Intermediate tables of one job, removed together once what they are for is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, fresh_path(spark, name)

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        drop_path(self.spark, self.folder)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII text takes the JVM's fast path."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def steady_malloc() -> None:
    """Let glibc return large arrays to the system when they are freed, whatever sizes came before."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 4 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 1 << 20)  # M_TRIM_THRESHOLD
    except (AttributeError, OSError):
        pass  # another C library


def tidy(run: Callable, *dumps: Callable[[], object]) -> Callable:
    """A mapInArrow function that gives its memory back at the end of a partition: idle Python workers stay alive beside busy ones."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        steady_malloc()
        try:
            yield from run(batches)
        finally:
            for d in dumps:
                d()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):
                pass  # another C library

    return wrapped
