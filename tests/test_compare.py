"""The cheap check agrees with the row diff."""

import random

import pytest

from conftest import rows
from ripplekit.operators import compare

SCHEMA = "a string, b string, n double"


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("seed", range(3))
def test_check_agrees_with_diff(spark, seed):
    rnd = random.Random(seed)
    row = lambda: (rnd.choice(["x", "y", "", None]), rnd.choice(["x", "y", None]),
                   rnd.choice([1.0, None]))
    data = [row() for _ in range(60)]
    shuffled = rnd.sample(data, len(data))
    a = frame(spark, data)
    cases = [(shuffled, True), (data[:-1], False), (data + data[:1], False), ([], False),
             (data[1:] + [("x", "changed", None)], False)]
    for other, equal in cases:
        b = frame(spark, other).repartition(5)
        got = compare.check(a, b).first()
        assert (got.equal, got.n_left, got.n_right) == (equal, len(data), len(other))
        assert compare.same_rows(a, b) == equal == compare.multiset_diff(a, b).isEmpty()
        assert rows(compare.diff_if_any(a, b).fillna("-").fillna(0)) == \
            rows(compare.multiset_diff(a, b).fillna("-").fillna(0))


def test_nulls_in_other_columns_and_empty_sides(spark):
    assert not compare.same_rows(frame(spark, [("x", None, 1.0)]), frame(spark, [(None, "x", 1.0)]))
    assert not compare.same_rows(frame(spark, [(None, None, None)]), frame(spark, []))
    assert compare.same_rows(frame(spark, []), frame(spark, []))
    # equal sums of counts are not equal rows
    assert not compare.same_rows(frame(spark, [("x", "y", 1.0)] * 2), frame(spark, [("x", "y", 1.0), ("x", "z", 1.0)]))
    assert compare.same_rows(frame(spark, [("x", "y", 1.0)]), frame(spark, [("x", "z", 1.0)]), ["a"])


def test_check_moves_one_row_per_task(spark):
    plan = compare.check(frame(spark, [("x", "y", 1.0)]), frame(spark, []))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "SinglePartition" in text and "hashpartitioning" not in text and "partial_sum" in text
