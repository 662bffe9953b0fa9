"""Key-value data as logs.

A put log ``key, value, seq`` replaces the in-memory map: the table is the
newest value per key (L1), a bulk load is an anti-join plus union (L2), a
read is a left join with ``''`` as the default (L3) and a snapshot is a
partitioned write (L4).  An operation log of client threads
(``sources.text.OPLOG_SCHEMA``) is paired into operations (L5) and
summarised into throughput and latency (L6).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.functions.strings import truncate2
from ripplekit.plans.ordered import Scan, ordered_scan


def latest_by_key(log: DataFrame, key: str = "key", value: str = "value",
                  seq: str = "seq") -> DataFrame:
    """L1: last write wins: ``key, value`` with the value of the largest
    ``seq``.  ``max_by`` aggregates partially before the shuffle."""
    return _last(log, key, value, F.col(seq))


def bulk_upsert(table: DataFrame, load: DataFrame, key: str = "key", value: str = "value",
                pos: str | None = None) -> DataFrame:
    """L2: overwrite ``table`` with the rows of ``load``.  Within one load a
    later position wins (``pos``; without it keys must be unique).  Both
    sides are tagged and meet in one aggregation."""
    at = F.lit(0) if pos is None else F.col(pos)
    both = table.select(key, value, F.lit(False).alias("_load"), F.lit(None).cast("long").alias("_pos")) \
        .unionByName(load.select(key, value, F.lit(True).alias("_load"), at.cast("long").alias("_pos")))
    return _last(both, key, value, F.struct("_load", "_pos"))


def apply_loads(log: DataFrame, is_load: Column, key: str = "key", value: str = "value",
                seq: str = "seq") -> DataFrame:
    """L2 on one log that holds the table's rows and, where ``is_load``, those
    of a bulk load: a load's row beats the table's, a later one an earlier."""
    return _last(log.select(key, value, F.struct(is_load, F.col(seq)).alias("_at")), key, value, F.col("_at"))


def _last(rows: DataFrame, key: str, value: str, at: Column) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(F.struct(F.col(value).alias("v")), at).alias("_l")) \
        .select(key, F.col("_l.v").alias(value))


def lookup_default(keys: DataFrame, table: DataFrame, key: str = "key", value: str = "value",
                   default: str = "") -> DataFrame:
    """L3: the value of every requested key, ``default`` when absent.  The
    join strategy is left to the planner (broadcast only under its size
    threshold, re-checked at run time by AQE)."""
    t = table.select(F.col(key).alias("_k"), F.col(value).alias("_v"))
    j = keys.join(t, keys[key] == t["_k"], "left")
    return j.select(*[keys[c] for c in keys.columns],
                    F.coalesce(F.col("_v"), F.lit(default)).alias(value))


def snapshot_export(table: DataFrame, path: str, records_per_file: int = 100_000,
                    partitions: int | None = None, mode: str = "errorifexists") -> None:
    """L4: write the table as parquet files of at most ``records_per_file``
    rows, written by ``partitions`` parallel tasks."""
    if partitions:
        table = table.repartition(partitions)
    table.write.mode(mode).option("maxRecordsPerFile", records_per_file).parquet(path)


def pair_operations(oplog: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row per invocation: ``tid, op, k, v, start, finish, status``.

    A thread has at most one open operation, so an invocation is completed
    by the next log row of its thread when that row is a response on the
    same key; otherwise it is ``pending`` (``finish`` null).  ``v`` is the
    value written, or the value a completed read returned."""
    s = ordered_scan(oplog, ["tid"], ["t"],
                     [Scan("nx", "lead", F.struct("phase", "t", "k", "v"))], partitions)
    inv = s.where(F.col("phase") == "inv")
    done = (F.col("nx.phase") == "res") & (F.col("nx.k") == F.col("k"))
    done = F.coalesce(done, F.lit(False))
    return inv.select(
        "tid", "op", "k",
        F.when(F.col("op") == "w", F.col("v")).when(done, F.col("nx.v")).alias("v"),
        F.col("t").alias("start"),
        F.when(done, F.col("nx.t")).alias("finish"),
        F.when(done, F.lit("ok")).otherwise(F.lit("pending")).alias("status"))


def throughput_report(ops: DataFrame, by: list[str]) -> DataFrame:
    """Per group, with log instants in microseconds: completed and
    pending operations, total latency of completed ones (µs), their mean
    latency in milliseconds truncated to 2 decimals, and the throughput in
    operations per second, ``floor(1e6 * completed / span)``, with ``span``
    from the first start to the last finish of the group.  An empty ``by``
    gives the one report of the whole run; a group without a completed
    operation or without a span has null rates."""
    done = F.col("status") == "ok"
    lat = F.when(done, F.col("finish") - F.col("start"))
    agg = ops.groupBy(*by).agg(
        F.count(F.when(done, 1)).alias("n_ok"),
        F.count(F.when(~done, 1)).alias("n_pending"),
        F.sum(lat).cast("long").alias("total_latency_us"),
        F.min("start").alias("_t0"), F.max("finish").alias("_t1"))
    span = F.col("_t1") - F.col("_t0")
    return agg.select(
        *by, "n_ok", "n_pending", "total_latency_us",
        truncate2(F.try_divide("total_latency_us", "n_ok") / F.lit(1000.0)).alias("avg_latency_ms"),
        F.floor(F.try_divide(F.lit(1e6) * F.col("n_ok"), span)).cast("long").alias("throughput_per_s"))
