"""Corpus pipeline over the documents table: reject low quality, keep one of
each group of near-duplicates, redact personal data, mix languages to target
weights, pack into token sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage
before kept, and calls one operator of ``ripplekit.llm``; its result is
written as Parquet and read again.  All stages but the last return the
columns of ``docs``.  Rows without a ``doc_id`` pass the first four stages as
they are; the last leaves them out.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.llm import mixing, packing, pii, quality, simhash
from ripplekit.llm.common import text_hash, unused
from ripplekit.llm.queries import MIX
from ripplekit.plans.lineage import materialize
from ripplekit.session import ship_package
from ripplekit.sources.tables import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least 0.5 stay."""
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    score = unused(docs, "score")
    return quality.with_quality(docs, model, out=score).where(F.col(score) >= 0.5).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays: of the smallest id in it; of several texts
    under that id that of the smallest hash, of several rows with that text
    one.  Rows of one id whose texts lie in different groups are judged each
    by its own text."""
    groups = materialize(simhash.near_duplicates(docs, shingle=3, distance=2), "near-duplicates")
    same = groups.where("doc_id = component_id").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    first = same.groupBy("doc_id").agg(F.min("text_hash").alias("text_hash"), F.min_by("n", "text_hash").alias("n"))
    losers = groups.where("doc_id <> component_id").select("doc_id", "text_hash").distinct().unionByName(
        same.join(first, ["doc_id", "text_hash"], "left_anti").select("doc_id", "text_hash"))
    hash_ = unused(docs, "text_hash")
    hashed = docs.withColumn(hash_, text_hash())

    def of(df):
        return (hashed["doc_id"] == df["_doc"]) & (hashed[hash_] == df["_hash"])
    # Written, so that their sizes are known and a few do not move the texts.
    named = [F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")]
    repeated = materialize(first.where("n > 1").select(*named), "repeated-rows")
    gone = materialize(losers.select(*named).unionByName(repeated), "near-duplicates-gone")
    row = F.struct(*docs.columns)
    once = hashed.join(repeated, of(repeated)).groupBy("doc_id", hash_).agg(F.min_by(row, F.xxhash64(row)).alias("row"))
    return hashed.join(gone, of(gone), "left_anti").select(*docs.columns) \
        .unionByName(once.select("row.*").select(*docs.columns))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind in brackets; rows
    that share an id each by what was found in their own text."""
    name, hash_ = unused(docs, "spans"), unused(docs, "text_hash")
    spans = pii.find_pii(docs).where(F.size("spans") > 0).groupBy("doc_id", "text_hash") \
        .agg(F.first("spans").alias(name)).withColumnRenamed("text_hash", hash_)
    return docs.withColumn(hash_, text_hash()).join(spans, ["doc_id", hash_], "left") \
        .withColumn("text", pii.redacted(F.col("text"), F.col(name))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or dropped so that the languages' shares of all
    tokens match the targets."""
    labelled = table(spark, sf_dir, "labels").select("doc_id").distinct() \
        .join(docs.select("doc_id", F.col("lang").alias("label")), "doc_id")
    tokens, posterior = unused(docs, "tokens"), unused(docs, "posterior")
    _, fitted, scored = mixing.mix(docs, labelled, MIX, keep=tuple(docs.columns), tokens=tokens, posterior=posterior)
    return mixing.repeated(scored, fitted, docs.columns, posterior)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their token ids and their place in
    sequences of 2048 tokens.  Other stages' workers need the memory of the
    words, so these are not kept between tasks."""
    return packing.pack(docs, with_ids=True, keep_words=False)


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", near_dedup),
    ("PII", redact_pii),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

# Trained models, XXH64 and tokenizers are beyond SQL: tested stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
