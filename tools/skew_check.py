"""Compare the skew-safe ordered scan with a plain per-key window on
generated rows where one key holds a third of the data (an experiment, not
a registered job).  Usage: python tools/skew_check.py [rows] [cores]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ripplekit.plans.ordered import Scan, ordered_scan  # noqa: E402
from ripplekit.session import local_session  # noqa: E402


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    cores = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    spark = local_session(cores)
    df = spark.range(0, n, numPartitions=2 * cores).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
         .otherwise(F.concat(F.lit("k"), (F.col("id") % 100_000).cast("string"))).alias("k"),
        F.col("id").alias("t"), (F.col("id") % 11).alias("x"))
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.select("k", "t", F.sum("x").over(w).alias("s"))
    chunked = ordered_scan(df, ["k"], ["t"], [Scan("s", "sum", F.col("x"))])
    for rep in range(2):
        for label, out in (("per-key window", plain), ("ordered scan", chunked)):
            t = time.time()
            r = out.agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("n")).first()
            print(f"{label:15s} run {rep}: {time.time() - t:6.1f} s  checksum {r['s']} rows {r['n']}",
                  flush=True)


if __name__ == "__main__":
    main()
