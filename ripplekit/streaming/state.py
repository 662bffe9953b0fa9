"""The durable state of a streaming query, read back as tables.

The state of the two keyed operators lies in the checkpoint folder.  Spark's
state data source reads it without the query, as of the last committed
micro-batch or an earlier one, in as many tasks as the state has partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def operator_ids(spark: SparkSession, checkpoint: str) -> dict[str, int]:
    """Numbers of the stateful operators of a checkpoint by name (a few rows
    of metadata)."""
    rows = spark.read.format("state-metadata").load(checkpoint).select("operatorName", "operatorId").distinct()
    return {r["operatorName"]: r["operatorId"] for r in rows.collect()}


def _state(spark: SparkSession, checkpoint: str, operator: str, batch: int | None, **options) -> DataFrame:
    found = operator_ids(spark, checkpoint)
    if operator not in found:
        raise ValueError(f"no operator {operator} in {checkpoint}, only {sorted(found)}")
    reader = spark.read.format("statestore").option("operatorId", found[operator]).options(**options)
    if batch is not None:
        reader = reader.option("batchId", batch)
    return reader.load(checkpoint)


def _rows(tables: DataFrame) -> DataFrame:
    """The rows of tables of which every group of keys holds one, as an array
    per column."""
    return tables.select(F.inline(F.arrays_zip(*tables.columns)))


def student_rooms(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``student string, room string``: where every student is (C1); students
    without a room have no state.  ``batch``: as of this micro-batch."""
    s = _state(spark, checkpoint, "applyInPandasWithState", batch)
    return _rows(s.select("value.groupState.*"))


def rooms(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``room string, cnt long, seen boolean, cap int, prev_over long``: the
    count of a room (valid once a student was ``seen``), its capacity (null:
    none) and the count of its last joined update if that was over capacity."""
    s = _state(spark, checkpoint, "transformWithStateInPandasExec", batch, stateVarName="rooms")
    return _rows(s.select("value.*"))


def latest_tables(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """``src, key, val`` strings: the two input tables (``student``,
    ``class``) as in ``operators.occupancy.latest_state`` and the count table
    (``count``)."""
    r = rooms(spark, checkpoint, batch)
    text = lambda src, key, val: [F.lit(src).alias("src"), F.col(key).alias("key"),
                                  F.col(val).cast("string").alias("val")]
    return student_rooms(spark, checkpoint, batch).select(*text("student", "student", "room")) \
        .unionByName(r.where("cap is not null").select(*text("class", "room", "cap"))) \
        .unionByName(r.where("seen").select(*text("count", "room", "cnt")))
