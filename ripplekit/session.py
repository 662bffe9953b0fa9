"""Session construction for tests, the bench and local runs.

On a cluster the session is created by the launcher; the library never
depends on these settings for correctness, only for speed.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

from ripplekit.plans.lineage import own_checkpoint_dir


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python workers import it;
    once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="ripplekit-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/ripplekit.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(path)


def local_session(cores: int | None = None, app: str = "ripplekit",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    parts = shuffle_partitions or cores
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(parts))
         .config("spark.default.parallelism", str(parts))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         # Python workers and the streaming state server talk to the JVM
         # over unix sockets, not loopback ports.
         .config("spark.python.unix.domain.socket.enabled", "true")
         .config("spark.driver.memory", os.environ.get("RIPPLEKIT_DRIVER_MEM", "16g"))
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"))
    env = os.environ.get("RIPPLEKIT_CONF", "")
    for kv in filter(None, env.split(",")):
        k, v = kv.split("=", 1)
        b = b.config(k, v)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    own_checkpoint_dir(spark)
    ship_package(spark)
    return spark
