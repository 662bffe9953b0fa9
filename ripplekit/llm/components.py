"""Connected components of an edge table, by alternating large and small
stars: every node is tied to the smallest node that it knows, first among its
larger and then among its smaller neighbours, until each component is one
star around its smallest node.  Each half-round is a few joins and
aggregations; its result is written to the shared folder, which also cuts
the lineage.  Nothing is collected but a count of changed edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.plans.lineage import materialize


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """``u, v`` with u > v: each u's neighbours (all larger ones, or for a
    small star the smaller ones and u itself) point to u's minimum."""
    pairs = edges.select("u", "v")
    if not small:
        pairs = pairs.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # The minimum per node is written first: the join then has two plain
    # exchanges, which Spark can split where one node has very many edges.
    least = materialize(pairs.groupBy("u").agg(F.min("v").alias("m")), "star")
    j = pairs.join(least, "u")
    if small:
        out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v") \
            .unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = j.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
    return materialize(out.distinct(), "edges")


def components(edges: DataFrame) -> DataFrame:
    """``node long, root long`` for every node of ``edges(u long, v long)``;
    the root is the smallest node that can be reached.  Loops and repeated
    edges do no harm; an empty table gives an empty one."""
    e = materialize(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        e = _star(_star(e, small=False), small=True)
        sign = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign == before:
            break
        before = sign
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
