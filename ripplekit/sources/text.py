"""Text sources: line scans, the delimited rating matrix, ``key,value``
ingest lines, the operation-log schema and the calibration report."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplekit.functions.strings import comma_fields, first_field, strict_int, text_lines

# Operation log: one row per invocation or response of a client thread.
OPLOG_SCHEMA = T.StructType([
    T.StructField("t", T.LongType(), False),        # log instant, distinct
    T.StructField("tid", T.LongType(), False),      # client thread
    T.StructField("phase", T.StringType(), False),  # 'inv' | 'res'
    T.StructField("op", T.StringType(), False),     # 'w' | 'r'
    T.StructField("k", T.StringType(), False),
    T.StructField("v", T.StringType(), True),       # write inv / read res
])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line (``value string``); ``path`` may be a folder."""
    return spark.read.text(path)


def lines_of_column(df: DataFrame, text_col: str, out: str = "value") -> DataFrame:
    """One row per line of a text column (documents stored as values)."""
    return df.select(F.explode(text_lines(text_col)).alias(out))


def parse_matrix(lines: DataFrame, col: str = "value", strict: bool = True) -> DataFrame:
    """M0: ``title,r1,...,rN`` -> ``title string, cells array<string>,
    ratings array<int>``.  Every comma splits, trailing blanks count as
    cells, a blank cell is a missing rating (null in ``ratings``).  With
    ``strict`` a cell that is not an integer fails the job; otherwise it
    becomes null."""
    f = comma_fields(col)
    parsed = lines.select(f.alias("_f"))
    cells = F.slice(F.col("_f"), 2, F.greatest(F.size("_f") - 1, F.lit(0)))
    parsed = parsed.select(F.col("_f")[0].alias("title"), cells.alias("cells"))
    if strict:
        conv = lambda c: F.when(c == "", F.lit(None).cast("int")).otherwise(strict_int(c))
    else:
        conv = lambda c: F.when(c.rlike(r"^[+-]?[0-9]+$"), c.try_cast("int"))
    return parsed.withColumn("ratings", F.transform("cells", conv))


def titles(lines: DataFrame, col: str = "value") -> DataFrame:
    """S3: ``title`` of every matrix line, the rest is not split."""
    return lines.select(first_field(col).alias("title"))


def parse_key_value(lines: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Console-producer style ``key,value`` line; split at the first
    comma only.  A line without a comma has a null value.  Columns in
    ``keep`` (such as a position) stay."""
    parts = F.split(F.col(col), ",", 2)
    return lines.select(*keep, parts[0].alias("key"),
                        F.when(F.size(parts) > 1, parts[1]).alias("val"))


def read_oplog(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Operation log with the explicit schema (no inference)."""
    return spark.read.format(fmt).schema(OPLOG_SCHEMA).load(path)


def render_oplog(log: DataFrame) -> DataFrame:
    """The operation log as JSON lines, ``value string`` (null fields are left
    out)."""
    return log.select(F.to_json(F.struct(*OPLOG_SCHEMA.fieldNames())).alias("value"))


def parse_oplog(lines: DataFrame, col: str = "value") -> DataFrame:
    """S9 from JSON lines: the log's columns by the explicit schema, ``line``
    and ``state``: ``ok``, ``malformed`` (no JSON object, or a value of another
    type), ``missing_field`` (one that may not be null) or ``bad_value`` (an
    unknown ``phase`` or ``op``).  Blank lines are left out, as by the JSON
    source; unknown fields are ignored."""
    fields = [T.StructField(f.name, f.dataType) for f in OPLOG_SCHEMA]
    schema = T.StructType([*fields, T.StructField("_malformed", T.StringType())])
    row = F.from_json(col, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"})
    parsed = lines.where(F.trim(F.col(col)) != "").select(F.col(col).alias("line"), row.alias("row"))
    field = lambda f: F.col(f"row.{f}")
    missing = [field(f.name).isNull() for f in OPLOG_SCHEMA if not f.nullable]
    state = (F.when(F.col("row").isNull() | field("_malformed").isNotNull(), F.lit("malformed"))
             .when(reduce(or_, missing), F.lit("missing_field"))
             .when(~field("phase").isin("inv", "res") | ~field("op").isin("w", "r"), F.lit("bad_value"))
             .otherwise(F.lit("ok")))
    return parsed.select(*[field(f.name).alias(f.name) for f in OPLOG_SCHEMA], "line", state.alias("state"))


def good_operations(parsed: DataFrame) -> DataFrame:
    """The usable rows of :func:`parse_oplog`."""
    return parsed.where("state = 'ok'").select(*OPLOG_SCHEMA.fieldNames())


def parse_calibration(lines: DataFrame, col: str = "value") -> DataFrame:
    """Timing report lines ``Throughput for logRounds=<c>: <x>`` and
    ``Latency for logRounds=<c>: <ms>`` -> ``cost int, metric string,
    value double``."""
    rx = r"^(Throughput|Latency) for logRounds=([0-9]+): ([0-9.Ee+-]+)$"
    return (lines.where(F.col(col).rlike(rx))
            .select(F.regexp_extract(col, rx, 2).cast("int").alias("cost"),
                    F.lower(F.regexp_extract(col, rx, 1)).alias("metric"),
                    F.regexp_extract(col, rx, 3).cast("double").alias("value")))
