"""The registered jobs: each takes ``(spark, sf_dir)``, reads the driver's
tables (or data Spark derives from them) and returns a typed DataFrame.
Column names equal those of the SQL checks in ``ripplekit.oracle``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.operators import compare, digests, history, kvlog, occupancy, ratings, words
from ripplekit.plans.lineage import materialize, scratch_path
from ripplekit.sources import derived
from ripplekit.sources.bucketed import buckets_for, write_bucketed
from ripplekit.sources.tables import table
from ripplekit.sources.sinks import write_lines
from ripplekit.sources.text import (good_operations, lines_of_column, parse_key_value, parse_matrix, parse_oplog,
                                    read_lines, read_oplog, titles)


# -- W1 ----------------------------------------------------------------------

def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(lines_of_column(table(spark, sf_dir, "documents"), "text"))


def text_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 from text files to text files: the documents' lines are written
    (K2), scanned (S1) and counted; the counts are written as ``word,n`` lines
    (K1), written again over those, sorted within each file (K3, O1), and
    read back (S8)."""
    src, out = scratch_path(spark, "lines"), scratch_path(spark, "word-counts")
    write_lines(lines_of_column(table(spark, sf_dir, "documents"), "text"), src, ["value"])
    counts = words.word_count(read_lines(spark, src))
    write_lines(counts, out, ["word", "n"])
    write_lines(counts, out, ["word", "n"], mode="overwrite", sort_by=["word"])
    return read_lines(spark, out)


# -- M0-M4 -------------------------------------------------------------------

def _matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_matrix(derived.matrix_lines(spark, sf_dir))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _matrix(spark, sf_dir)
    return p.select(
        "title",
        F.size("cells").cast("int").alias("width"),
        F.size(F.filter("ratings", lambda x: x.isNotNull())).cast("int").alias("n_rated"),
        F.aggregate("ratings", F.lit(0).cast("long"),
                    lambda acc, x: acc + F.coalesce(x, F.lit(0)).cast("long")).alias("rating_sum"))


def top_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ratings.top_users(_matrix(spark, sf_dir))
    return t.select("title", F.array_join(F.col("top_users").cast("array<string>"), ",")
                    .alias("top_users"))


def total_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.total_ratings(_matrix(spark, sf_dir))


def ratings_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings.ratings_per_user(_matrix(spark, sf_dir))


def matrix_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: the titles alone, read from the matrix as a text file."""
    path = scratch_path(spark, "matrix")
    write_lines(derived.matrix_lines(spark, sf_dir), path, ["value"])
    return titles(read_lines(spark, path))


def similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: all pairs of suppliers with the months in which their counts agree,
    pairs without one too."""
    return ratings.similarity(_matrix(spark, sf_dir), min_score=None)


# -- X1 ----------------------------------------------------------------------

def output_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = derived.diff_sides(spark, sf_dir)
    return compare.multiset_diff(a, b, ["line"])


def output_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheap check first: per pair of results whether they are equal and,
    only if not, by how many rows they differ."""
    a, b = derived.diff_sides(spark, sf_dir)
    repeated = a.unionByName(a.orderBy("line").limit(1))
    pairs = {"slices": (a, b), "reordered": (a, a.repartition("line")), "repeated": (a, repeated)}
    out = []
    for name, (x, y) in pairs.items():
        differing = compare.diff_if_any(x, y).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long"))
        out.append(compare.check(x, y).select(
            F.lit(name).alias("pair"), "equal", "n_left", "n_right", differing.scalar().alias("n_diff")))
    return out[0].unionByName(out[1]).unionByName(out[2])


# -- C1-C4 -------------------------------------------------------------------

def latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occupancy.latest_state(derived.occupancy_log(spark, sf_dir))


def room_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occupancy.room_counts(derived.occupancy_log(spark, sf_dir))


def room_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occupancy.room_status(derived.occupancy_log(spark, sf_dir))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return occupancy.alerts(derived.occupancy_log(spark, sf_dir))


def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1-C8 as a Structured Streaming query: the occupancy log is written
    as files of increasing ``seq`` and replayed through the stateful
    stream; the appended alerts are read back."""
    from ripplekit.streaming.occupancy import replay_log
    return replay_log(spark, derived.occupancy_log(spark, sf_dir),
                      scratch_path(spark, "stream-alerts"))


def stream_alerts_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same replay, but the query stops after half of the log and
    a new one goes on from its checkpoint."""
    from ripplekit.streaming.occupancy import replay_log
    return replay_log(spark, derived.occupancy_log(spark, sf_dir),
                      scratch_path(spark, "stream-restart"), restart=True)


def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: how many alerts and recoveries the monitored stream reported, from
    its progress, next to nothing else: one row."""
    from ripplekit.streaming.occupancy import replay_log
    seen: list[dict] = []
    replay_log(spark, derived.occupancy_log(spark, sf_dir), scratch_path(spark, "stream-counts"), progress=seen)
    return spark.createDataFrame([(sum(p["alerts"] for p in seen), sum(p["recoveries"] for p in seen))],
                                 "alerts long, recoveries long")


def _in_batches(spark: SparkSession, sf_dir: str, least: int = 4) -> tuple[DataFrame, int]:
    """The occupancy log, and rows per micro-batch so that there are ``least``
    micro-batches or more and state crosses them at every size."""
    from ripplekit.streaming.occupancy import ROWS_PER_BATCH
    log = derived.occupancy_log(spark, sf_dir)
    return log, max(1, min(ROWS_PER_BATCH, log.count() // least))


def _streamed(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    from ripplekit.streaming.occupancy import replay_updates
    log, size = _in_batches(spark, sf_dir)
    rows = replay_updates(spark, log, scratch_path(spark, f"stream-{kind}"), rows_per_batch=size)
    return rows.where(F.col("kind") == kind)


def stream_room_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2 as a stream: the count updates among the tagged updates of one
    replay."""
    return _streamed(spark, sf_dir, "count").select("seq", "sub", "room", "cnt")


def stream_room_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C3 as a stream: the joined updates among the tagged updates."""
    return _streamed(spark, sf_dir, "joined").select("seq", "sub", "room", "cap", "cnt")


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that a replayed query has left in its checkpoint, read
    back: both input tables and the count table."""
    from ripplekit.streaming import occupancy as stream
    from ripplekit.streaming.state import latest_tables
    work = scratch_path(spark, "stream-state")
    log, size = _in_batches(spark, sf_dir)
    stream.replay_log(spark, log, work, rows_per_batch=size, restart=True)
    return latest_tables(spark, f"{work}/checkpoint")


def stream_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: updates of the student, capacity, count and joined tables and
    alerts, as a listener has counted them while the query ran; one row per
    table."""
    from ripplekit.streaming import occupancy as stream
    from ripplekit.streaming.monitor import monitored
    work, runs = scratch_path(spark, "stream-monitor"), []

    def begin(rows, checkpoint):
        updates = stream.observed(stream.room_stream(stream.observed_log(rows)))
        runs.append(stream.start(updates, checkpoint, path=f"{work}/out", partition_by=("kind",)))
        return runs[-1]

    log, size = _in_batches(spark, sf_dir)
    with monitored(spark) as monitor:
        stream.replay(spark, log, work, begin, size)
        for q in runs:
            monitor.wait(q.runId)
        totals = {k: n for q in runs for metric in monitor.totals(q.id).values() for k, n in metric.items()}
    return spark.createDataFrame([(k, int(n)) for k, n in totals.items()], "name string, n long")


def stream_batch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C6 with a sink that is fed by ``foreachBatch``: the alerts, committed a
    micro-batch at a time under its number."""
    from ripplekit.streaming import occupancy as stream
    from ripplekit.streaming.batch_table import BatchTable
    work = scratch_path(spark, "stream-batches")
    table_ = BatchTable(spark, f"{work}/table", "ts long, sub int, room string, value string")

    def begin(rows, checkpoint):
        alerts_ = stream.alerts_stream(rows).select("ts", "sub", "room", "value")
        return stream.start(alerts_, checkpoint, each_batch=table_.each_batch)

    log, size = _in_batches(spark, sf_dir)
    stream.replay(spark, log, work, begin, size, restart=True)
    return table_.read().select(F.col("ts").alias("seq"), "sub", "room", "value")


def ingested_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 into C1: the student moves as ``key,value`` console lines (no comma:
    a deletion), scanned from text with their position, and their latest
    state."""
    path = scratch_path(spark, "moves")
    moves = derived.occupancy_log(spark, sf_dir).where("src = 'student'")
    line = F.concat_ws(",", F.format_string("%020d", "seq"), "key", "val")
    write_lines(moves.select(line.alias("value")), path, ["value"])
    scanned = read_lines(spark, path).select(
        F.substring_index("value", ",", 1).cast("long").alias("seq"),
        F.substring("value", 22, 1 << 30).alias("value"))
    log = parse_key_value(scanned, keep=("seq",)).withColumn("src", F.lit("student"))
    return occupancy.latest_state(log)


# -- L1-L6 -------------------------------------------------------------------

def _put_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("user_id").alias("key"), F.col("props").alias("value"),
                     F.col("event_id").alias("seq"))


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kvlog.latest_by_key(_put_log(spark, sf_dir))


def bulk_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the put log is the table, the second half one bulk
    load (later positions win within the load)."""
    log = _put_log(spark, sf_dir)
    split = log.agg(F.floor((F.max("seq") + 1) / 2)).scalar()
    return kvlog.apply_loads(log, F.col("seq") >= split)


def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    return kvlog.lookup_default(keys, kvlog.latest_by_key(_put_log(spark, sf_dir)))


def lookup_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L3 against a table that is bucketed by key: only the keys move."""
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    puts = kvlog.latest_by_key(_put_log(spark, sf_dir))
    return kvlog.lookup_default(keys, write_bucketed(puts, ["key"], buckets_for(keys)))


def snapshot_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the table as a chunked snapshot under the shared checkpoint
    folder and read it back."""
    path = scratch_path(spark, "snapshot")
    kvlog.snapshot_export(kvlog.latest_by_key(_put_log(spark, sf_dir)), path,
                          records_per_file=100_000)
    return spark.read.parquet(path)


def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L4 with a small bound: that the snapshot takes more than one file, that
    none has more rows than the bound, and the rows of all."""
    path, bound = scratch_path(spark, "snapshot"), 10
    kvlog.snapshot_export(kvlog.latest_by_key(_put_log(spark, sf_dir)), path, records_per_file=bound)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return files.agg((F.count(F.lit(1)) > 1).alias("several"), (F.max("n") <= bound).alias("bounded"),
                     F.sum("n").alias("n"))


def op_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kvlog.pair_operations(read_oplog(spark, derived.operation_log(spark, sf_dir)))


def json_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 as text: the operation log from JSON lines, some of them damaged;
    operations are paired from the good ones."""
    lines = read_lines(spark, derived.operation_log_json(spark, sf_dir))
    return kvlog.pair_operations(good_operations(parse_oplog(lines)))


def json_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the JSON log by their state."""
    lines = read_lines(spark, derived.operation_log_json(spark, sf_dir))
    return parse_oplog(lines).groupBy("state").agg(F.count(F.lit(1)).alias("n"))


def op_report_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one report of the whole run."""
    return kvlog.throughput_report(op_pairing(spark, sf_dir), [])


def op_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kvlog.throughput_report(op_pairing(spark, sf_dir), ["op"])


def op_report_by_thread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kvlog.throughput_report(op_pairing(spark, sf_dir), ["tid"])


# -- L7 ----------------------------------------------------------------------

def history_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.check_history(op_pairing(spark, sf_dir))


def history_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.score_summary(history_check(spark, sf_dir))


# -- D1-D3 -------------------------------------------------------------------

def _doc_salt() -> F.Column:
    return F.md5(F.col("doc_id").cast("string"))


def salted_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests.salted_digest(docs, "text", salt=_doc_salt()).select("doc_id", "digest")


def _values_and_digests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Texts, every 7th changed, and stored digests of the unchanged ones,
    every 11th cut short (malformed)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stored = digests.salted_digest(docs, "text", salt=_doc_salt()).select(
        "doc_id",
        F.when(F.col("doc_id") % 11 == 0, F.substring("digest", 1, 40))
         .otherwise(F.col("digest")).alias("digest"))
    values = docs.select(
        "doc_id",
        F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("."))).otherwise(F.col("text"))
         .alias("text"))
    return values, stored


def verify_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the documents checked against an altered copy."""
    values, stored = _values_and_digests(spark, sf_dir)
    return digests.verify_digest(values, stored, on="doc_id", col="text")


def verify_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the texts in a table bucketed by id and the digests in a
    table: only the digests move."""
    values, stored = _values_and_digests(spark, sf_dir)
    return digests.verify_digest(write_bucketed(values, ["doc_id"], buckets_for(values)),
                                 materialize(stored, "digests"), on="doc_id", col="text")


def hash_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests.audit_hashes(derived.stored_hashes(spark, sf_dir), "hash", min_cost=10)


JOBS = {
    "word_count": word_count,
    "text_word_count": text_word_count,
    "matrix_titles": matrix_titles,
    "rating_lines": rating_lines,
    "top_users": top_users,
    "total_ratings": total_ratings,
    "ratings_per_user": ratings_per_user,
    "similarity": similarity,
    "output_diff": output_diff,
    "output_check": output_check,
    "latest_state": latest_state,
    "room_counts": room_counts,
    "room_status": room_status,
    "alerts": alerts,
    "stream_alerts": stream_alerts,
    "stream_alerts_restarted": stream_alerts_restarted,
    "stream_counts": stream_counts,
    "stream_room_counts": stream_room_counts,
    "stream_room_status": stream_room_status,
    "stream_state": stream_state,
    "stream_monitor": stream_monitor,
    "stream_batch_table": stream_batch_table,
    "ingested_state": ingested_state,
    "latest_by_key": latest_by_key,
    "bulk_upsert": bulk_upsert,
    "lookup_default": lookup_default,
    "lookup_bucketed": lookup_bucketed,
    "snapshot_export": snapshot_export,
    "snapshot_files": snapshot_files,
    "op_pairing": op_pairing,
    "json_pairing": json_pairing,
    "json_bad_lines": json_bad_lines,
    "op_report_total": op_report_total,
    "op_report": op_report,
    "op_report_by_thread": op_report_by_thread,
    "history_check": history_check,
    "history_summary": history_summary,
    "salted_digest": salted_digest,
    "verify_digest": verify_digest,
    "verify_bucketed": verify_bucketed,
    "hash_audit": hash_audit,
}
