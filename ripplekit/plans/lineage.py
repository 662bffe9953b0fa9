"""Intermediate tables.

Results that are read several times, or whose recomputation after an
executor loss would be expensive, are written to the shared folder named by
``spark.checkpoint.dir`` and read back.  The library never picks a folder
itself: a session without the setting gets an error, except that tests, the
bench and the driver's entry call :func:`own_checkpoint_dir` first.  All
tables of an application lie in one folder, which :func:`drop_scratch`
removes when the application is done with its results.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get(_CONF, None)
        if not folder:
            raise RuntimeError(f"{_CONF} is not set: name a folder that the driver and all executors share")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def own_checkpoint_dir(spark: SparkSession) -> str:
    """Like :func:`ensure_checkpoint_dir`, but a local session without the
    setting (tests, the bench, the driver's checks) gets a temporary folder
    that goes with the process; on a cluster it stays an error."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir() and not spark.conf.get(_CONF, None) and sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="ripplekit-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return ensure_checkpoint_dir(spark)


def _root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ripplekit-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the application's folder for an intermediate table."""
    return f"{_root(spark)}/{name}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files behind results that are written:
    its cleaner acts when the driver has let go of them and collects
    garbage, which between two large jobs it may not do by itself."""
    gc.collect()
    spark._jvm.System.gc()


def drop_scratch(spark: SparkSession) -> None:
    """Remove all intermediate tables of this application; results that were
    not yet collected or written elsewhere can no longer be read."""
    drop_path(spark, _root(spark))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a parquet table in the application's folder and read it
    back: later plans start from a scan (column pruning and filter pushdown
    still apply), and task retries or lost executors never recompute the
    upstream lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
