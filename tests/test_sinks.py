"""K1-K3: text sinks and their save modes."""

import pytest
from pyspark.errors import AnalysisException

from ripplekit.plans.lineage import scratch_path
from ripplekit.sources.sinks import render_lines, write_lines
from ripplekit.sources.text import read_lines


def test_key_value_and_value_only_lines(spark):
    df = spark.createDataFrame([("a", 1, [1, 3]), ("b", 2, [])], "k string, n long, u array<int>")
    assert sorted(r.value for r in render_lines(df, ["k", "n"]).collect()) == ["a,1", "b,2"]
    assert sorted(r.value for r in render_lines(df, ["n"]).collect()) == ["1", "2"]
    assert sorted(r.value for r in render_lines(df, ["k", "u"]).collect()) == ["a,1,3", "b,"]


def test_existing_result_is_kept_unless_overwritten(spark):
    path = scratch_path(spark, "sink-test")
    df = spark.createDataFrame([("a", 1)], "k string, n long")
    write_lines(df, path)
    with pytest.raises(AnalysisException):
        write_lines(df, path)
    write_lines(df.selectExpr("k", "n + 1 AS n"), path, mode="overwrite")
    assert [r.value for r in read_lines(spark, path).collect()] == ["a,2"]


def test_sorted_output_files(spark):
    path = scratch_path(spark, "sink-sorted")
    df = spark.createDataFrame([(k, 1) for k in "dbca"], "k string, n long").repartition(1)
    write_lines(df, path, sort_by=["k"])
    assert [r.value for r in read_lines(spark, path).collect()] == ["a,1", "b,1", "c,1", "d,1"]


def test_first_field(spark):
    from ripplekit.functions.strings import first_field
    df = spark.createDataFrame([("A,1,2",), ("B",), ("",)], "value string")
    assert [r.t for r in df.select(first_field("value").alias("t")).collect()] == ["A", "B", ""]
