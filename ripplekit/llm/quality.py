"""Quality classifier on supervised subword embeddings (``subword.py``).

A third of the labelled rows, by crc32 of the id, is held out of training;
neither labels nor any column but the text is an input of a score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.llm import subword
from ripplekit.llm.common import bounded_batches

CLASSES = ("0", "1")


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
                rows: int = subword.SAMPLE_ROWS) -> subword.Model:
    """Model of ``label_col`` (0 or 1) from the rows that are not held out."""
    return subword.train(docs, labels.where(~held_out()).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("string").alias("label")),
        CLASSES, rows)


def with_quality(docs: DataFrame, model: subword.Model, text_col: str = "text",
                 out: str = "score") -> DataFrame:
    """``docs`` with ``out double``: the probability of label 1.  Null and
    empty texts get the probability that the labels alone suggest; no row is
    left out, and a column named ``out`` is replaced."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(out, F.round(subword.posterior_column(model, text_col)[1], 9))
