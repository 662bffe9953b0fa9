"""Inputs derived from the driver's tables, so every job's work grows with
the data.  The rules are fixed by the fixture description and are written
identically in the DuckDB oracle of ``__spark_entry__``.

* rating matrix: one line per supplier, one cell per shipping month;
* occupancy log: student moves and room capacities from ``events``;
* operation log: write/read invocations and responses from ``events``;
* diff sides: two overlapping slices of ``orders`` as text lines;
* stored hashes: bcrypt-shaped strings from ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.plans.lineage import materialize, scratch_path
from ripplekit.plans.ordered import Scan, ordered_scan
from ripplekit.sources.sinks import write_lines
from ripplekit.sources.tables import table
from ripplekit.sources.text import OPLOG_SCHEMA, read_oplog


def matrix_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value string`` lines ``s_name,c1,...,cM``: one cell per month that
    occurs in ``lineitem`` (ascending); the cell is ``count % 6`` of the
    supplier's lines shipped in that month, blank when that is 0 or there
    are none.  Suppliers without lines get all-blank rows."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_suppkey", F.month("l_shipdate").alias("m"))
    counts = materialize(li.groupBy("l_suppkey", "m").agg(F.count(F.lit(1)).alias("n")), "supplier-months")
    # The month set is a scalar subquery over the grouped rows: at most 12
    # values, never a join against the data.
    months = counts.agg(F.array_sort(F.collect_set("m"))).scalar()
    per_sup = (counts.groupBy("l_suppkey")
               .agg(F.map_from_entries(F.collect_list(F.struct("m", (F.col("n") % 6).alias("r"))))
                    .alias("cm")))
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    # The month set is projected once per row, so the plan holds the
    # subquery once.
    grid = sup.join(per_sup, sup.s_suppkey == per_sup.l_suppkey, "left") \
        .select("s_name", "cm", months.alias("months"))

    def cell(m: int):
        r = F.element_at(F.col("cm"), F.lit(m))
        return F.when(r.isNull() | (r == 0), F.lit("")).otherwise(r.cast("string"))

    # One slot per calendar month, kept when the month occurs in the data
    # (no lambda: a scalar subquery may not sit inside a higher-order
    # function).  Cells are never null, so compaction only drops absent months.
    cells = F.array_compact(F.array(*[
        F.when(F.array_contains(F.col("months"), F.lit(m)), cell(m)) for m in range(1, 13)]))
    return grid.select(F.concat(F.col("s_name"), F.lit(","), F.array_join(cells, ",")).alias("value"))


def occupancy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changelog of two upsert tables, ``seq long, src string, key string,
    val string``: ``src='student'`` rows map a student to a room,
    ``src='class'`` rows set a room's capacity; a null ``val`` deletes."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value")
    n_users = ev.agg(F.countDistinct("user_id")).scalar()
    rooms = F.greatest(F.lit(2), F.floor(n_users / 5))
    room = F.concat(F.lit("room-"),
                    ((F.floor(F.col("event_id") / 20) + F.col("user_id")) % rooms).cast("string"))
    is_class = (F.col("event_id") % 20) == 0
    tomb = (F.col("event_id") % 17) == 0
    cap = (F.floor(F.col("value")) % 8 + 2).cast("string")
    return ev.select(
        F.col("event_id").alias("seq"),
        F.when(is_class, F.lit("class")).otherwise(F.lit("student")).alias("src"),
        F.when(is_class, room).otherwise(F.col("user_id").cast("string")).alias("key"),
        F.when(tomb, F.lit(None).cast("string"))
         .when(is_class, cap).otherwise(room).alias("val"))


def operation_log(spark: SparkSession, sf_dir: str) -> str:
    """Path of an operation log (``sources.text.OPLOG_SCHEMA``) of a key-value client.

    Per event: thread ``event_id % 8``, key ``key-<user_id>``, a write for
    click / purchase / signup events, else a read; invocation at
    ``event_id*1000``, response after ``(5 + floor(value) % 70) * 100 + 1 +
    event_id % 8``; no response when ``event_id % 53 = 0``.  Writes store
    ``value-<event_id>``, but ``value-shared`` when ``event_id % 101 = 1``, so
    that some keys write a value twice.  A read returns the latest earlier write on its key
    (``''`` if none); every 97th event returns the write before that one
    when it exists (a stale read) and every 101st returns junk."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    ops = ev.select(
        "event_id",
        (F.col("event_id") % 8).alias("tid"),
        F.concat(F.lit("key-"), F.col("user_id").cast("string")).alias("k"),
        F.when(F.col("event_type").isin("click", "purchase", "signup"), F.lit("w"))
         .otherwise(F.lit("r")).alias("op"),
        (F.col("event_id") * 1000).alias("start"),
        (F.col("event_id") * 1000 + (F.lit(5) + F.floor(F.col("value")) % 70) * 100
         + 1 + F.col("event_id") % 8).cast("long").alias("finish"),
        ((F.col("event_id") % 53) == 0).alias("pending"))
    wval = F.when(F.col("event_id") % 101 == 1, F.lit("value-shared")).otherwise(
        F.concat(F.lit("value-"), F.col("event_id").cast("string")))
    is_w = F.col("op") == "w"
    # Pass 1: every operation learns the latest write before it on its key
    # (for a write, that is its predecessor).  Pass 2: every operation learns
    # the latest earlier write together with that write's predecessor.
    # Pass 1 is written before pass 2 samples and moves it.
    s1 = materialize(ordered_scan(ops, ["k"], ["event_id"],
                                  [Scan("pw", "last_before", F.when(is_w, wval))]), "oplog-pass1")
    marker = F.when(is_w, F.struct(wval.alias("w1"), F.col("pw").alias("w2")))
    scanned = ordered_scan(s1, ["k"], ["event_id"], [Scan("lw", "last_before", marker)])
    e = F.col("event_id")
    read_val = (F.when(e % 101 == 0, F.concat(F.lit("junk-"), e.cast("string")))
                .when((e % 97 == 0) & F.col("lw.w2").isNotNull(), F.col("lw.w2"))
                .otherwise(F.coalesce(F.col("lw.w1"), F.lit(""))))
    inv = scanned.select(F.col("start").alias("t"), "tid", F.lit("inv").alias("phase"), "op", "k",
                         F.when(is_w, wval).alias("v"))
    res = scanned.where(~F.col("pending")).select(
        F.col("finish").alias("t"), "tid", F.lit("res").alias("phase"), "op", "k",
        F.when(~is_w, read_val).alias("v"))
    path = scratch_path(spark, "oplog")
    inv.unionByName(res).write.parquet(path)
    return path


def operation_log_json(spark: SparkSession, sf_dir: str) -> str:
    """Path of the operation log as JSON lines of which some are damaged, by
    their instant ``t``: cut in the middle (``t % 59 = 0``), a word instead of
    the instant (``t % 71 = 0``), without a phase (``t % 61 = 0``), an unknown
    phase (``t % 67 = 0``); the first that applies."""
    log = read_oplog(spark, operation_log(spark, sf_dir))
    t, line = F.col("t"), F.col("value")
    whole = log.select("t", F.to_json(F.struct(*OPLOG_SCHEMA.fieldNames())).alias("value"))
    damaged = (F.when(t % 59 == 0, F.expr("substring(value, 1, length(value) div 2)"))
               .when(t % 71 == 0, F.regexp_replace(line, '"t":[0-9]+', '"t":"soon"'))
               .when(t % 61 == 0, F.regexp_replace(line, '"phase":"[a-z]+",', ""))
               .when(t % 67 == 0, F.regexp_replace(line, '"phase":"[a-z]+"', '"phase":"maybe"'))
               .otherwise(line))
    path = scratch_path(spark, "oplog-json")
    write_lines(whole.select(damaged.alias("value")), path, ["value"])
    return path


def diff_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two overlapping result sets of ``line string``: ``priority,status``
    of orders with ``o_orderkey % 3 <> 0`` and ``<> 1``."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    line = F.concat_ws(",", "o_orderpriority", "o_orderstatus").alias("line")
    a = o.where(F.col("o_orderkey") % 3 != 0).select(line)
    b = o.where(F.col("o_orderkey") % 3 != 1).select(line)
    return a, b


def stored_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id long, hash string``: bcrypt-shaped strings of every class of the
    audit: bad versions, revisions, rounds and salts, missing ends of the
    rounds, wrong lengths, weak costs, and the form without a revision."""
    e = F.col("event_id")
    ev = table(spark, sf_dir, "events").select("event_id")
    prefix = (F.when(e % 7 == 0, F.lit("$3a$")).when(e % 7 == 1, F.lit("$2x$"))
              .when(e % 7 == 2, F.lit("$2$")).otherwise(F.lit("$2a$")))
    rounds = (F.when(e % 11 == 0, F.lit("99")).when(e % 5 == 0, F.lit("06"))
              .otherwise(F.lit("12")))
    body = F.concat(F.md5(e.cast("string")), F.md5((e + 1).cast("string")))
    body = F.substring(body, 1, 53)
    body = (F.when(e % 13 == 0, F.substring(body, 1, 20)).when(e % 13 == 1, F.substring(body, 1, 52))
            .otherwise(body))
    end = F.when(e % 17 == 0, F.lit("-")).otherwise(F.lit("$"))
    return ev.select(e.alias("id"), F.concat(prefix, rounds, end, body).alias("hash"))
