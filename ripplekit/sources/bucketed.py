"""Tables bucketed and sorted by key.

A table that is looked up again and again is shuffled by its key once, when
it is written.  A join on the key then moves only the other side: Spark deals
its rows into the table's buckets, and the table is read where it lies.  The
text of a large table never goes through a shuffle again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.plans.lineage import scratch_path

BUCKET_ROWS = 1_000_000


def buckets_for(df: DataFrame, rows: int = BUCKET_ROWS, least: int = 8) -> int:
    """Buckets of about ``rows`` rows each."""
    return max(least, -(-df.count() // rows))


def write_bucketed(df: DataFrame, by: list[str], buckets: int, name: str | None = None,
                   path: str | None = None) -> DataFrame:
    """Write ``df`` as a table of ``buckets`` buckets by the columns ``by``,
    each one file, sorted by them, and return it as read from the catalog
    under ``name`` (by default a fresh one, in the application's folder).  A
    null key gets a bucket like any other."""
    spark = df.sparkSession
    name = name or f"bucketed_{uuid.uuid4().hex}"
    # The same hash as that of the buckets, so a task writes one bucket.
    df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by) \
        .option("path", path or scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def bucketing(spark: SparkSession, name: str) -> tuple[int, list[str]]:
    """Number of buckets and bucket columns of a table, (0, []) if it has none."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE FORMATTED {name}")
            .where(F.col("col_name").isin("Num Buckets", "Bucket Columns")).collect()}
    columns = rows.get("Bucket Columns", "[]").strip("[]").replace("`", "")
    return int(rows.get("Num Buckets", 0)), [c.strip() for c in columns.split(",") if c.strip()]
