"""The ordered scan equals a plain per-key scan, including a hot key spread
over many partitions."""

import random

import pytest
from pyspark.sql import functions as F

from ripplekit.plans.ordered import Scan, ordered_scan


def _brute(data):
    by_key = {}
    for k, seq, x in sorted(data, key=lambda r: (r[0], r[1])):
        by_key.setdefault(k, []).append((seq, x))
    out = {}
    for k, items in by_key.items():
        run, last_nn, mx = None, None, None
        for i, (seq, x) in enumerate(items):
            lag = items[i - 1][1] if i > 0 else None
            lead = items[i + 1][1] if i + 1 < len(items) else None
            before_last, before_max = last_nn, mx
            if x is not None:
                run = (run or 0) + x
                last_nn = x
                mx = x if mx is None else max(mx, x)
            out[(k, seq)] = (lag, lead, run, last_nn, before_last, before_max)
    return out


@pytest.mark.parametrize("partitions", [1, 2, 7, 40, None])
def test_scan_matches_brute_force(spark, partitions):
    rnd = random.Random(partitions)
    data = []
    for seq in range(300):
        k = "hot" if rnd.random() < 0.4 else f"k{rnd.randint(0, 9)}"
        data.append((k, seq * 3 + rnd.randint(0, 2), rnd.choice([None, None, 1, 2, 5, -3])))
    df = spark.createDataFrame(data, "k string, seq long, x int")
    out = ordered_scan(df, ["k"], ["seq"], [
        Scan("lag", "lag", F.col("x")), Scan("lead", "lead", F.col("x")),
        Scan("run", "sum", F.col("x").cast("long")),
        Scan("last", "last", F.col("x")), Scan("lb", "last_before", F.col("x")),
        Scan("mb", "max_before", F.col("x"))], partitions).collect()
    got = {(r.k, r.seq): (r.lag, r.lead, r.run, r.last, r.lb, r.mb) for r in out}
    assert got == _brute(data)
    assert len(out) == len(data)


@pytest.mark.parametrize("partitions", [1, 2, 5])
def test_running_sum_skips_nulls(spark, partitions):
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate([None, 5, None, None, None, 2])],
                               "k string, seq long, x int")
    out = ordered_scan(df, ["k"], ["seq"], [Scan("s", "sum", F.col("x"))], partitions)
    assert [r.s for r in sorted(out.collect(), key=lambda r: r.seq)] == [None, 5, 5, 5, 5, 7]


def test_a_key_takes_up_partitions_of_bounded_size(spark):
    from ripplekit.plans import ordered
    placed = []
    keep = ordered.materialize
    ordered.materialize = lambda df, name: placed.append(keep(df, name)) or placed[-1]
    try:
        df = spark.range(0, 4000).select(F.lit("only").alias("k"), "id")
        ordered_scan(df, ["k"], ["id"], [Scan("p", "lag", F.col("id"))], 8).collect()
    finally:
        ordered.materialize = keep
    sizes = [r["count"] for r in placed[0].groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * 4000 / 8


@pytest.mark.parametrize("partitions", [1, 3, 11, None])
def test_argument_of_the_running_maximum(spark, partitions):
    rnd = random.Random(partitions)
    data = [(f"k{min(2, rnd.randint(0, 6))}", i, rnd.choice([None, rnd.randint(0, 400)]), f"v{i}") for i in range(200)]
    df = spark.createDataFrame(data, "k string, seq long, x int, v string")
    out = ordered_scan(df, ["k"], ["seq"], [
        Scan("best", "arg_max_before", F.struct("x", "v"))], partitions).collect()
    assert len(out) == len(data)
    for r in out:
        before = [(x, v) for k, i, x, v in data if k == r.k and i < r.seq and x is not None]
        assert (None if r.best is None else tuple(r.best)) == max(before, default=None)


def test_input_with_the_helpers_names(spark):
    df = spark.createDataFrame([("a", i, i * i, 7, 8, 9) for i in range(20)],
                               "k string, seq long, _part int, _e0 int, _S0 int, __c0 int")
    out = ordered_scan(df, ["k"], ["seq"], [Scan("s", "sum", F.col("_part").cast("long"))], 3)
    assert out.columns == [*df.columns, "s"]
    got = sorted((r.seq, r._part, r._e0, r._S0, r["__c0"], r.s) for r in out.collect())
    assert got == [(i, i * i, 7, 8, 9, sum(j * j for j in range(i + 1))) for i in range(20)]
