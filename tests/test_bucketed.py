"""Joins with bucketed tables move only the other side."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from ripplekit.operators import digests, kvlog
from ripplekit.plans.lineage import materialize, scratch_path
from ripplekit.sources.bucketed import bucketing, buckets_for, write_bucketed


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def exchanged(df):
    """Columns below every shuffle of the plan that was run."""
    df.collect()
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    text = text.split("== Initial Plan ==")[0] + text
    return [set(re.findall(r"(\w+)#\d+", m)) for m in
            re.findall(r"\(\d+\) Exchange\n(?:Input|Output) \[\d+\]: \[([^\]]*)\]", text)]


def test_text_is_not_shuffled(spark, no_broadcast):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    stored = materialize(digests.salted_digest(docs, "text", F.md5(F.col("doc_id").cast("string")))
                         .select("doc_id", "digest"), "digests")
    values = write_bucketed(docs, ["doc_id"], 6)
    plain = digests.verify_digest(docs, stored, on="doc_id", col="text")
    bucketed = digests.verify_digest(values, stored, on="doc_id", col="text")
    assert any("text" in cols for cols in exchanged(plain))
    moved = exchanged(bucketed)
    assert moved and not any("text" in cols for cols in moved) and any("digest" in cols for cols in moved)
    assert rows(bucketed) == rows(plain) and bucketed.where("ok").count() == docs.count()


def test_lookup_moves_only_the_keys(spark, no_broadcast):
    puts = spark.range(0, 500).select((F.col("id") % 97).alias("key"), F.col("id").cast("string").alias("value"),
                                      F.col("id").alias("seq"))
    puts = kvlog.latest_by_key(puts)
    table = write_bucketed(puts, ["key"], 5)
    keys = spark.range(0, 200).select((F.col("id") * 3).alias("key"))
    got = kvlog.lookup_default(keys, table)
    moved = exchanged(got)
    assert moved and not any("value" in cols for cols in moved)
    assert rows(got) == rows(kvlog.lookup_default(keys, puts))


def test_table_has_buckets_and_null_keys(spark):
    df = spark.createDataFrame([(None, "n"), (1, "a"), (2, "b"), (1, "c")], "key long, value string")
    path = scratch_path(spark, "bucketed-test")
    table = write_bucketed(df, ["key"], 3, "bucketed_for_a_test", path)
    assert bucketing(spark, "bucketed_for_a_test") == (3, ["key"])
    assert sorted(map(str, rows(table.fillna(-1)))) == sorted(map(str, rows(df.fillna(-1))))
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.collect_list("key").alias("ks"))
    assert all(r.ks == sorted(r.ks) for r in files.collect()) and files.count() <= 3
    assert buckets_for(df, rows=1, least=2) == 4 and buckets_for(df, least=2) == 2
    spark.sql("DROP TABLE bucketed_for_a_test")
