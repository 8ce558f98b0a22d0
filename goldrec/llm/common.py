"""Shared helpers: the run's scratch tables and the shipping of task code."""

from __future__ import annotations

import atexit
import gc
import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The word of most contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ship(module_name: str) -> None:
    """Send a module's functions to the workers by value, so that they need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only a local session without the setting, as in tests, gets a folder of its own.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="goldrec-llm-"))
    return sc.getCheckpointDir()


class Scratch:
    """Tables of one run in the shared folder; they outlive lost executors and cut lineage.

    The returned DataFrames read them lazily, so they go when the driver ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, name: str) -> None:
        """Delete the tables saved under ``name``, once all that was derived from them is saved itself."""
        self._delete(f"{self.root}/{name}-*")

    def _delete(self, pattern: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for found in fs.globStatus(path) or []:
            fs.delete(found.getPath(), True)

    def drop(self) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(self.root)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session has ended: the folder's owner cleans it
            pass


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished steps now, not at some later collection.

    Spark still refers to the last query's plan; a query of one row takes its place.
    """
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def lean(run: Callable) -> Callable:
    """``run`` over batches; when it ends, the worker gives its free memory back, as later stages reuse it."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim:
                trim(0)

    return wrapped


def steady(run: Callable) -> Callable:
    """``run`` over batches; the worker keeps what large arrays leave until ``lean`` gives it back.

    Else every array of some 100 KB gets fresh pages, which takes longer than a pass over it.
    The values are those that glibc itself comes to once 32 MB were freed at a time.
    """

    def wrapped(batches):
        import ctypes

        mallopt = getattr(ctypes.CDLL(None), "mallopt", None)  # glibc has it
        if mallopt:
            mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD
            mallopt(-1, 64 << 20)  # M_TRIM_THRESHOLD
        yield from run(batches)

    return wrapped


def lower_ascii(c: Column) -> Column:
    """A-Z to a-z, all else unchanged."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ship(__name__)
