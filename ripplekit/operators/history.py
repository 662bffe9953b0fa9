"""Consistency check of a read/write history (per-key zone test).

The test needs written values that are unique per key.  A value written
twice (or the initial value written at all) is reported as
``duplicate_write`` (score 2) and its key is not tested further; every other
key is checked with the zone test of Gibbons and Korach ("Testing Shared Memories", SIAM J.
Comput. 1997):

* operations are grouped into clusters ``(key, value)``: the write of the
  value and the reads that returned it; a virtual write of ``''`` precedes
  everything (an absent key reads as ``''``);
* a read whose value was never written is junk (score 2);
* with ``f`` the earliest finish and ``s`` the latest start of a cluster,
  the zone is forward when ``f < s`` (covering ``[f, s]``), else backward
  (covering ``[s, f]``);
* score 1: a read finished before its write started (``read_before_write``),
  two forward zones of a key overlap (``overlap``: reported for the one
  starting later), or a backward zone lies inside a forward zone
  (``containment``).  ``other`` is the value of the forward zone that it
  overlaps or lies in: of all that started before, the one that ends last.

Pending writes count with an infinite finish when some read returned their
value, otherwise they are dropped; pending reads are dropped.  All instants
must be distinct.

Plan: one aggregation per cluster, then a running maximum of forward-zone
ends, with the zone's value as its argument, per key in zone order (``plans.ordered``, bounded window partitions
even for a hot key) instead of a self-join of clusters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.plans.lineage import materialize
from ripplekit.plans.ordered import Scan, ordered_scan

NEG_INF = -(1 << 62)
POS_INF = 1 << 62


def clusters(ops: DataFrame) -> DataFrame:
    """``k, v, has_write, duplicate, ws, rf, f, s`` per cluster from paired operations
    (``operators.kvlog.pair_operations``)."""
    is_w = F.col("op") == "w"
    done = F.col("status") == "ok"
    ops = ops.where(is_w | done).select(
        "k", "v", "op", "start",
        F.when(done, F.col("finish")).otherwise(F.lit(POS_INF)).alias("finish"))
    g = ops.groupBy("k", "v").agg(
        F.min(F.when(F.col("op") == "w", F.col("start"))).alias("ws"),
        F.min(F.when(F.col("op") == "w", F.col("finish"))).alias("wf"),
        F.min(F.when(F.col("op") == "r", F.col("finish"))).alias("rf"),
        F.count(F.when(F.col("op") == "r", 1)).alias("n_reads"),
        F.count(F.when(F.col("op") == "w", 1)).alias("n_writes"),
        F.min("finish").alias("f"), F.max("start").alias("s"))
    initial = F.col("v") == ""
    # A pending write nobody read is dropped; the virtual initial write is
    # folded into the '' cluster instead of being materialised per key.
    wf_pending_unread = (F.col("wf") == F.lit(POS_INF)) & (F.col("n_reads") == 0)
    g = g.where(~(wf_pending_unread & ~initial & (F.col("n_writes") == 1)))
    return g.select(
        "k", "v",
        (F.col("ws").isNotNull() | initial).alias("has_write"),
        (F.col("n_writes") > F.when(initial, 0).otherwise(1)).alias("duplicate"),
        F.when(initial, F.lit(NEG_INF)).otherwise(F.col("ws")).alias("ws"),
        "rf",
        F.when(initial, F.lit(NEG_INF + 1)).otherwise(F.col("f")).alias("f"),
        F.when(initial, F.greatest(F.col("s"), F.lit(NEG_INF))).otherwise(F.col("s")).alias("s"))


def check_history(ops: DataFrame, partitions: int | None = None) -> DataFrame:
    """``k, v, score int, reason string, other string``: one row per offending
    cluster; ``other`` is null unless the reason is an overlap or containment."""
    # One row per cluster, written once: the zone scan and the reports read it
    # instead of re-running the pairing.
    c = materialize(clusters(ops), "history-clusters")
    none = F.lit(None).cast("string").alias("other")
    junk = c.where(~F.col("has_write")).select(
        "k", "v", F.lit(2).alias("score"), F.lit("junk").alias("reason"), none)
    twice = c.where("duplicate").select(
        "k", "v", F.lit(2).alias("score"), F.lit("duplicate_write").alias("reason"), none)
    z = c.where("has_write").join(twice.select("k").distinct(), "k", "left_anti").select(
        "k", "v", "ws", "rf",
        (F.col("f") < F.col("s")).alias("fwd"),
        F.least("f", "s").alias("lo"), F.greatest("f", "s").alias("hi"))
    z = ordered_scan(z, ["k"], ["lo", "v"],
                     [Scan("last", "arg_max_before", F.struct(F.when(F.col("fwd"), F.col("hi")).alias("hi"), "v"))],
                     partitions)
    reason = (F.when(F.col("rf") < F.col("ws"), F.lit("read_before_write"))
              .when(F.col("fwd") & (F.col("last.hi") > F.col("lo")), F.lit("overlap"))
              .when(~F.col("fwd") & (F.col("last.hi") > F.col("hi")), F.lit("containment")))
    bad = z.select("k", "v", F.lit(1).alias("score"), reason.alias("reason"), "last").where("reason is not null") \
        .select("k", "v", "score", "reason",
                F.when(F.col("reason") != "read_before_write", F.col("last.v")).alias("other"))
    return junk.unionByName(twice).unionByName(bad)


def score_summary(checked: DataFrame) -> DataFrame:
    """Counts per score, the two numbers the original run reports."""
    return checked.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
