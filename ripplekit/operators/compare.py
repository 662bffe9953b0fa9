"""Order-insensitive comparison of two results.

Both inputs are tagged +1 / -1 and summed per row value in one aggregation
(partial aggregation before the shuffle, so duplicated rows collapse early).
A surplus on the left is reported as ``<``, on the right as ``>``, with the
multiplicity.  An empty result means the two multisets are equal.

Results that are equal, the usual case, need no shuffle of rows: 128-bit
hashes of the rows, added with the sign of their side, give zero in any order,
and repeated rows count.  ``check`` finds out in one aggregation of which each
task sends one row; ``diff_if_any`` moves rows only if the sides differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _signed(a: DataFrame, b: DataFrame, cols: list[str]) -> DataFrame:
    return a.select(*cols, F.lit(1).alias("_d")).unionByName(b.select(*cols, F.lit(-1).alias("_d")))


def multiset_diff(a: DataFrame, b: DataFrame, cols: list[str] | None = None) -> DataFrame:
    cols = cols or a.columns
    net = _signed(a, b, cols).groupBy(*cols).agg(F.sum("_d").alias("_net")).where(F.col("_net") != 0)
    return net.select(*cols,
                      F.when(F.col("_net") > 0, F.lit("<")).otherwise(F.lit(">")).alias("side"),
                      F.abs("_net").cast("long").alias("n"))


def row_hashes(cols: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row.  Spark's hash passes over nulls, so which
    columns are null is hashed as well."""
    nulls = F.concat(F.lit(""), *[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in cols])
    return [F.xxhash64(F.lit(seed), nulls, *cols) for seed in (17, 71)]


def check(a: DataFrame, b: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One row ``equal boolean, n_left long, n_right long``: whether both sides
    hold the same rows with the same counts, by the signed sums of their
    hashes.  Decimals hold the sums of 10^18 rows; two empty sides are equal."""
    cols = cols or a.columns
    d = F.col("_d")
    sums = [F.coalesce(F.sum(h.cast("decimal(20,0)") * d), F.lit(0)) == 0 for h in row_hashes(cols)]
    n = lambda side: F.count(F.when(d == side, 1))
    return _signed(a, b, cols).agg(
        ((n(1) == n(-1)) & sums[0] & sums[1]).alias("equal"), n(1).alias("n_left"), n(-1).alias("n_right"))


def same_rows(a: DataFrame, b: DataFrame, cols: list[str] | None = None) -> bool:
    """True when ``a`` and ``b`` hold the same rows with the same counts."""
    return check(a, b, cols).first()["equal"]


def diff_if_any(a: DataFrame, b: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """:func:`multiset_diff`, but rows are only moved if the sides differ; an
    empty frame of the same columns otherwise."""
    diff = multiset_diff(a, b, cols)
    if same_rows(a, b, cols):
        return a.sparkSession.createDataFrame([], diff.schema)
    return diff
