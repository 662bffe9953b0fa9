"""L1-L6 on small logs."""

import os

from pyspark.sql import functions as F

from conftest import rows
from ripplekit.operators import kvlog
from ripplekit.plans.lineage import scratch_path
from ripplekit.sources.text import OPLOG_SCHEMA


def test_latest_upsert_lookup(spark):
    log = spark.createDataFrame([("a", "1", 0), ("b", "2", 1), ("a", "3", 2)],
                                "key string, value string, seq long")
    table = kvlog.latest_by_key(log)
    assert rows(table) == [("a", "3"), ("b", "2")]
    load = spark.createDataFrame([("b", "x", 0), ("c", "y", 1), ("b", "z", 2)],
                                 "key string, value string, pos long")
    up = kvlog.bulk_upsert(table, load, pos="pos")
    assert rows(up) == [("a", "3"), ("b", "z"), ("c", "y")]
    keys = spark.createDataFrame([("a",), ("q",)], "key string")
    assert rows(kvlog.lookup_default(keys, up)) == [("a", "3"), ("q", "")]


def test_snapshot_export_chunks(spark):
    df = spark.range(0, 2500).select(F.col("id").cast("string").alias("key"),
                                     F.lit("v").alias("value"))
    path = scratch_path(spark, "snap-test")
    kvlog.snapshot_export(df, path, records_per_file=1000, partitions=2)
    back = spark.read.parquet(path)
    assert back.count() == 2500
    files = [f for f in os.listdir(path.replace("file:", "")) if f.endswith(".parquet")]
    assert len(files) >= 3


def _log(spark, entries):
    return spark.createDataFrame(entries, OPLOG_SCHEMA)


def test_pairing_and_report(spark):
    entries = [
        (0, 1, "inv", "w", "k", "v1"), (5, 1, "res", "w", "k", None),
        (10, 1, "inv", "r", "k", None), (30, 1, "res", "r", "k", "v1"),
        (40, 1, "inv", "w", "k", "v2"),                       # pending: no response
        (50, 1, "inv", "r", "k", None), (60, 1, "res", "r", "k", "v2"),
        (2, 2, "inv", "r", "j", None), (9, 2, "res", "r", "j", ""),
    ]
    p = kvlog.pair_operations(_log(spark, entries), partitions=4)
    assert rows(p, "tid", "start", "op", "v", "finish", "status") == [
        (1, 0, "w", "v1", 5, "ok"), (1, 10, "r", "v1", 30, "ok"),
        (1, 40, "w", "v2", None, "pending"), (1, 50, "r", "v2", 60, "ok"),
        (2, 2, "r", "", 9, "ok")]
    rep = {r.op: r for r in kvlog.throughput_report(p, ["op"]).collect()}
    assert (rep["w"].n_ok, rep["w"].n_pending, rep["w"].total_latency_us) == (1, 1, 5)
    # 37 µs over 3 reads: 0.0123 ms, truncated
    assert (rep["r"].n_ok, rep["r"].total_latency_us, rep["r"].avg_latency_ms) == (3, 37, 0.01)
    assert rep["r"].throughput_per_s == 1_000_000 * 3 // 58
    total = kvlog.throughput_report(p, []).collect()
    assert [(r.n_ok, r.n_pending, r.total_latency_us) for r in total] == [(4, 1, 37 + 5)]


def test_report_without_span_or_completions(spark):
    p = spark.createDataFrame([("w", 5, 5, "ok"), ("r", 7, None, "pending")],
                              "op string, start long, finish long, status string")
    rep = {r.op: (r.n_ok, r.avg_latency_ms, r.throughput_per_s) for r in kvlog.throughput_report(p, ["op"]).collect()}
    assert rep == {"w": (1, 0.0, None), "r": (0, None, None)}


def test_loads_on_one_log(spark):
    log = spark.createDataFrame([("a", "1", 0), ("b", "2", 1), ("a", "3", 5), ("a", "4", 4)],
                                "key string, value string, seq long")
    assert rows(kvlog.apply_loads(log, F.col("seq") >= 4)) == [("a", "3"), ("b", "2")]
