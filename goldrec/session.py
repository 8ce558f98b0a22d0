"""Spark session helpers.

Library code never creates its own session; jobs receive one.  ``local_session``
is for tests, benchmarks and the driver contract only.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "goldrec") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("GOLDREC_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset (local tests) a fresh scratch folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current  # setting it again would nest a new folder in it
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder; a machine-local one is unsafe on a cluster")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="goldrec-ckpt-"))
    return sc.getCheckpointDir()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared checkpoint folder; what is written there goes when the driver ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def drop() -> None:
        try:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        except Exception:  # the session has ended: the folder's owner cleans it
            pass

    atexit.register(drop)
    return path


#: Rows of a table from which a task derives values many times their size.
ROWS_A_TASK = 20_000


def spread(df: DataFrame, rows: int = ROWS_A_TASK) -> DataFrame:
    """``df``, a table as it is read, dealt out to tasks of ``rows`` rows at most; a smaller one stays as it is.

    Spark cuts files by bytes and between row groups only, so a well compressed table of
    millions of rows comes in a few tasks, whatever is derived from its rows.
    """
    tasks = -(-df.count() // rows)
    return df.repartition(tasks) if tasks > 1 else df


def broadcast_if_few(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df``, which should be cheap to count, marked for broadcast if it has ``most`` rows at most; else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
