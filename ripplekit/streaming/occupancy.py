"""Room counts, joined updates and alerts as a Structured Streaming query.

Two keyed stateful operators in one query, both in append mode: the
student stage uses ``applyInPandasWithState`` (the state of a key travels
with its rows as Arrow batches) and the room stage
``transformWithStateInPandas`` (Spark allows only one
``applyInPandasWithState`` per query).  Spark calls a Python function once per
group and micro-batch, which costs milliseconds; with a group per student or
room, micro-batches times keys of them.  So students and rooms are dealt over
``BUCKETS`` groups by the hash of their key: a group's state is the table of
its keys, and all its rows of a micro-batch are handled at once, with array
operations on rows sorted by key:

1. per student: the old room is the room before, shifted by one row, with
   the state in front (C1); every update emits ``-1`` for the old room
   (``sub = 0``) and ``+1`` for the new one (``sub = 1``);
2. per room: the count is a running sum (C2), the capacity the last one set,
   a joined update (C3) a row where both exist, and an alert (C4) compares a
   joined update with the joined update before it.  The three come out of the
   one operator as rows tagged with their ``kind``, of which a query asks for
   those that it needs.

Every input update is emitted downstream, not only the last one per
micro-batch (C5), so the output equals the batch jobs ``room_counts``,
``room_status`` and ``alerts`` of ``operators.occupancy`` row for row.

Order: rows carry ``ts, src, part, off`` (broker timestamp, source, topic
partition, offset) and a key's rows of a micro-batch are handled in that
order.  Within one topic partition this is the order of the offsets, as long
as the broker's timestamps do not fall (log-append time); all updates of a
student or of a capacity share a key and thus a partition.  Across topics and
partitions it is the order of the timestamps; of equal ones the capacity
counts first.  Micro-batches are processed in arrival order, and a micro-batch
has at most ``rows_per_batch`` rows (``maxOffsetsPerTrigger``, or files of
that size with ``maxFilesPerTrigger``), which bounds what one group can bring
into a task.

Offsets, state (RocksDB, set on the session when starting) and the sink's
commit log live in the checkpoint folder, which gives exactly-once output
across restarts (C6, C7); a fresh checkpoint folder starts a run afresh (C8).
``streaming.state`` reads the state of a checkpoint as tables,
``streaming.monitor`` counts the updates of a running query (K5) and
``streaming.batch_table`` is an exactly-once sink without a commit log of its
own (C6).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ripplekit.functions.strings import strict_int

# The per-key functions below run in Python workers.  They are shipped by
# value, so workers need not have this package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_BATCH = 1_000_000   # of a micro-batch, at most
BUCKETS = 256                # groups of keys; the state of a checkpoint is kept by them
ORDER = ["ts", "src", "part", "off"]
_ORDER_SQL = "ts long, src string, part int, off long"

LOG_SCHEMA = T.StructType([
    T.StructField("ts", T.LongType()),
    T.StructField("src", T.StringType()),      # 'student' | 'class'
    T.StructField("part", T.IntegerType()),
    T.StructField("off", T.LongType()),
    T.StructField("key", T.StringType()),
    T.StructField("val", T.StringType()),
])

_UPDATE = f"{_ORDER_SQL}, sub int, room string, delta int, is_cap boolean, cap int"
KINDS = ("count", "joined", "alert")   # C2, C3, C4
_ROOM_UPDATE = f"{_ORDER_SQL}, sub int, room string, kind string, cap int, cnt long, value string"
_ALERT = f"{_ORDER_SQL}, sub int, room string, value string"
_STUDENT_STATE = "student array<string>, room array<string>"
_ROOM_STATE = T.StructType([   # a column of the table of a group's rooms each
    T.StructField("room", T.ArrayType(T.StringType())),
    T.StructField("cnt", T.ArrayType(T.LongType())),
    T.StructField("seen", T.ArrayType(T.BooleanType())),
    T.StructField("cap", T.ArrayType(T.IntegerType())),      # null: no capacity set
    T.StructField("prev_over", T.ArrayType(T.LongType())),   # count of the previous joined update if over
])


def bucket(key: str) -> Column:
    """The group of a student or room."""
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


def _ordered(pdfs: Iterator[pd.DataFrame], key: str, by: list[str]) -> tuple[pd.DataFrame, list, np.ndarray]:
    """A group's rows of this micro-batch, key by key in order, the keys in
    that order and where the rows of each begin."""
    batch = pd.concat(list(pdfs), ignore_index=True)
    code, keys = pd.factorize(batch[key].astype(object), use_na_sentinel=False)
    batch = batch.assign(_key=code).sort_values(["_key", *by], kind="stable", ignore_index=True)
    return (batch, [None if pd.isna(k) else k for k in keys],
            np.searchsorted(batch["_key"].to_numpy(), np.arange(len(keys))))


def student_rooms(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Stage 1, keyed by the bucket of the student: turns moves into room count
    deltas."""
    batch, students, begin = _ordered(pdfs, "key", ORDER)
    rooms = dict(zip(*state.get)) if state.exists else {}
    new = batch["val"].astype(object).where(batch["val"].notna(), None)
    old = new.shift(1).to_numpy(object)
    old[begin] = [rooms.get(s) for s in students]
    rooms.update(zip(students, new.to_numpy(object)[np.append(begin[1:], len(batch)) - 1]))
    rooms = {s: r for s, r in rooms.items() if r is not None}
    if rooms:
        state.update((list(rooms), list(rooms.values())))
    elif state.exists:
        state.remove()
    out = pd.concat([batch[ORDER].assign(sub=sub, room=room, delta=delta)[room.notna()]
                     for sub, room, delta in ((0, pd.Series(old, dtype=object), -1), (1, new, 1))],
                    ignore_index=True)
    if len(out):
        yield out.assign(is_cap=False, cap=pd.array([None] * len(out), dtype="Int32"))


def room_updates(batch: pd.DataFrame, begin: np.ndarray, state: list[tuple],
                 kinds: tuple[str, ...]) -> tuple[pd.DataFrame, list[tuple]]:
    """Updates of these kinds and the next states of some rooms, from their
    states and ordered changes; those of a room begin at its ``begin``."""
    n = len(batch)
    at_room = np.repeat(np.arange(len(begin)), np.diff(begin, append=n))
    cnt0, seen0, cap0, over0 = (
        np.array([s[f] for s in state], dtype) for f, dtype in enumerate((np.int64, bool, float, float)))
    is_cap = batch["is_cap"].to_numpy(bool)
    # running sums over all rows, less what they were where the room begins
    total = np.append(0, np.cumsum(np.where(is_cap, 0, batch["delta"].to_numpy(np.int64))))
    cnt = total[1:] - total[begin][at_room] + cnt0[at_room]
    moves = np.append(0, np.cumsum(~is_cap))
    seen = (moves[1:] > moves[begin][at_room]) | seen0[at_room]
    # the capacity of the room's last capacity row so far, or of its state; NaN: none
    set_at = np.maximum.accumulate(np.where(is_cap, np.arange(n), -1))
    caps = pd.to_numeric(batch["cap"], errors="coerce").to_numpy(float, na_value=np.nan)
    cap = np.where(set_at >= begin[at_room], caps[set_at], cap0[at_room])
    at = np.flatnonzero(seen & ~np.isnan(cap))
    over = cnt[at] > cap[at]
    # count of the room's joined update before if it was over, else NaN
    before = np.where(over, cnt[at].astype(float), np.nan)
    first = np.diff(at_room[at], prepend=-1) != 0
    prev = np.where(first, over0[at_room[at]], np.append(np.nan, before)[:len(at)])
    tell = over | (prev > cnt[at])
    rows = {"count": np.flatnonzero(~is_cap), "joined": at, "alert": at[tell]}
    parts = []
    for kind in kinds:
        i = rows[kind]
        none = pd.array([None] * len(i), dtype="Int32")
        parts.append(batch[[*ORDER, "sub", "room"]].iloc[i].assign(
            kind=kind,
            cap=pd.array(cap[i], dtype="Int32") if kind == "joined" else none,
            cnt=none.astype("Int64") if kind == "alert" else pd.array(cnt[i], dtype="Int64"),
            value=np.where(over, cnt[at].astype(str), "OK")[tell] if kind == "alert" else None))
    last = np.append(begin[1:], n) - 1
    over0[at_room[at]] = before      # of several, the last one stays
    after = [(int(c), bool(s), None if np.isnan(k) else int(k), None if np.isnan(o) else int(o))
             for c, s, k, o in zip(cnt[last], seen[last], cap[last], over0)]
    return (pd.concat([p for p in parts if len(p)], ignore_index=True) if any(map(len, parts)) else parts[0], after)


class RoomUpdates(StatefulProcessor):
    """Stage 2, keyed by the bucket of the room: count, capacity, join and
    alert."""

    def __init__(self, kinds: tuple[str, ...]):
        self.kinds = kinds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("rooms", _ROOM_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch, rooms, begin = _ordered(rows, "room", [*ORDER, "sub"])
        got = self.state.get()
        table = {} if got is None else {room: row for room, *row in zip(*got)}
        out, after = room_updates(batch, begin, [table.get(r, (0, False, None, None)) for r in rooms], self.kinds)
        table.update(zip(rooms, after))
        self.state.update((list(table), *map(list, zip(*table.values()))))
        if len(out):
            yield out

    def close(self) -> None:
        pass


def room_stream(log: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """Tagged updates from a streaming log of :data:`LOG_SCHEMA`: order
    columns, ``sub, room, kind`` and, by kind, ``cnt`` (``count``), ``cap,
    cnt`` (``joined``) or ``value`` (``alert``)."""
    if not kinds or not set(kinds) <= set(KINDS):
        raise ValueError(f"kinds must be some of {KINDS}, not {kinds!r}")
    students = log.where(F.col("src") == "student").select(*ORDER, "key", "val", bucket("key"))
    deltas = students.groupBy("bucket").applyInPandasWithState(
        student_rooms, outputStructType=_UPDATE, stateStructType=_STUDENT_STATE,
        outputMode="append", timeoutConf="NoTimeout")
    caps = log.where(F.col("src") == "class").select(
        *ORDER, F.lit(0).alias("sub"), F.col("key").alias("room"), F.lit(0).alias("delta"),
        F.lit(True).alias("is_cap"), strict_int(F.col("val"), "capacity").alias("cap"))
    return deltas.unionByName(caps).select("*", bucket("room")).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=RoomUpdates(tuple(kinds)), outputStructType=_ROOM_UPDATE, outputMode="Append",
        timeMode="None")


def alerts_stream(log: DataFrame) -> DataFrame:
    """Streaming alerts: order columns, ``sub, room, value``."""
    return room_stream(log, ("alert",)).select(*ORDER, "sub", "room", "value")


def topic_records(raw: DataFrame, src: str) -> DataFrame:
    """Log rows from the columns of a topic (``key, value`` binary or string,
    ``timestamp, partition, offset``).  A record without a key is dropped, as
    by a table that is read from a topic; a null value deletes."""
    return raw.where(F.col("key").isNotNull()).select(
        F.unix_millis("timestamp").alias("ts"), F.lit(src).alias("src"), F.col("partition").cast("int").alias("part"),
        F.col("offset").cast("long").alias("off"), F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("val"))


def topic_log(spark: SparkSession, bootstrap: str, student_topic: str, class_topic: str,
              starting_offsets: str = "earliest", rows_per_batch: int = ROWS_PER_BATCH) -> DataFrame:
    """The streaming log from two Kafka topics of ``key`` / ``value``
    strings (a null value deletes), as produced by console producers with
    ``parse.key=true`` and ``key.separator=,``; a micro-batch takes at most
    ``rows_per_batch`` records, half from each topic.  Needs the Kafka
    connector on the classpath."""
    def one(topic: str, src: str) -> DataFrame:
        try:
            raw = (spark.readStream.format("kafka")
                   .option("kafka.bootstrap.servers", bootstrap)
                   .option("subscribe", topic)
                   .option("maxOffsetsPerTrigger", max(1, rows_per_batch // 2))
                   .option("startingOffsets", starting_offsets).load())
        except Exception as e:  # connector missing
            raise RuntimeError("the Kafka source needs the spark-sql-kafka connector "
                               "on the classpath; use a file source instead") from e
        return topic_records(raw, src)
    return one(student_topic, "student").unionByName(one(class_topic, "class"))


def alert_messages(alerts: DataFrame) -> DataFrame:
    """K4: ``key string, value string`` (room, alert): the columns that a
    topic sink takes."""
    return alerts.select(F.col("room").alias("key"), "value")


def _use_rocksdb(spark: SparkSession) -> None:
    key = "spark.sql.streaming.stateStore.providerClass"
    want = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    if spark.conf.get(key, None) != want:
        spark.conf.set(key, want)


def observed(updates: DataFrame) -> DataFrame:
    """Tagged updates whose numbers of counts, joined updates, alerts and
    recoveries are reported per micro-batch as the metric ``updates``."""
    of = lambda c: F.count(F.when(c, 1))
    return updates.observe(
        "updates", *[of(F.col("kind") == k).alias(k) for k in KINDS], of(F.col("value") == "OK").alias("recovery"))


def observed_log(log: DataFrame) -> DataFrame:
    """The log, whose numbers of student and capacity updates (deletions
    included) are reported per micro-batch as the metric ``log``."""
    return log.observe("log", *[F.count(F.when(F.col("src") == s, 1)).alias(n)
                                for s, n in (("student", "student"), ("class", "capacity"))])


def start(rows: DataFrame, checkpoint: str, available_now: bool = True, **sink):
    """Start a query on a streaming DataFrame; ``sink``: ``path`` (and
    ``partition_by``) for an exactly-once parquet folder, or ``each_batch``, a
    function of a micro-batch's rows and number.

    A micro-batch opens and commits every state partition.  Its rows are
    bounded, so partitions follow the cores, up to two for each, not the
    session's number, which follows the whole input; a checkpoint keeps its
    number."""
    spark = rows.sparkSession
    _use_rocksdb(spark)
    w = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    if "each_batch" in sink:
        w = w.foreachBatch(sink["each_batch"])
    else:
        w = w.format("parquet").option("path", sink["path"]).partitionBy(*sink.get("partition_by", ()))
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 2 * spark.sparkContext.defaultParallelism)))
    try:
        return w.start()    # the query runs in a copy of the session
    finally:
        spark.conf.set(key, before)


def start_alerts(spark: SparkSession, log: DataFrame, out_dir: str, checkpoint: str,
                 available_now: bool = True):
    """Start the alert query on a streaming log with an exactly-once
    parquet sink; returns the ``StreamingQuery``."""
    # Per micro-batch counts in the query progress (``observedMetrics``),
    # the monitoring counterpart of printing every update.
    out = alerts_stream(log).observe(
        "alerts", F.count(F.lit(1)).alias("alerts"),
        F.count(F.when(F.col("value") == "OK", 1)).alias("recoveries"))
    return start(out, checkpoint, available_now, path=out_dir)


def _stage(log: DataFrame, path: str, rows_per_batch: int, first_time: int) -> int:
    """Write ``log`` as files of about ``rows_per_batch`` rows, cut by ``ts``
    in one distributed write, and give them modification times in that order:
    a file stream takes older files first.  Returns the time behind them."""
    spark = log.sparkSession
    n = max(1, -(-log.count() // rows_per_batch))
    # the progress of every micro-batch is kept, for its counts
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(2 * n + 100))
    log.repartitionByRange(n, "ts").write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted(str(f.getPath()) for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    for k, f in enumerate(files):
        fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(f), first_time + 1000 * k, -1)
    return first_time + 1000 * len(files)


def replay(spark: SparkSession, log: DataFrame, workdir: str, begin: Callable, rows_per_batch: int = ROWS_PER_BATCH,
           restart: bool = False) -> list[dict] | None:
    """Replay a batch log ``seq, src, key, val`` through a streaming query and
    return the progress of its micro-batches (None: the log is empty and
    nothing was started).

    The log is staged as files in ``seq`` order of about ``rows_per_batch``
    rows; ``begin(stream, checkpoint)`` starts an ``availableNow`` query, which
    consumes a file per micro-batch, so state crosses micro-batches as in a
    long-running query.  With ``restart`` the second half of the log is staged
    and consumed by a new query on the same checkpoint.  ``workdir`` must be on
    shared storage on a cluster (use ``plans.lineage.scratch_path``)."""
    in_dir, checkpoint = f"{workdir}/in", f"{workdir}/checkpoint"
    rows = log.select(F.col("seq").cast("long").alias("ts"), F.col("src"), F.lit(0).alias("part"),
                      F.lit(0).cast("long").alias("off"), "key", "val")
    ends = rows.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    if ends["lo"] is None:
        return None
    middle = F.lit((ends["lo"] + ends["hi"]) // 2)
    waves = [rows.where(F.col("ts") <= middle), rows.where(F.col("ts") > middle)] if restart else [rows]
    time, seen = 1_000_000_000_000, []
    for k, wave in enumerate(waves):
        time = _stage(wave, f"{in_dir}/w{k}", rows_per_batch, time)
        stream = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{in_dir}/*")
        q = begin(stream, checkpoint)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        seen += q.recentProgress
    return seen


def replay_log(spark: SparkSession, log: DataFrame, workdir: str, rows_per_batch: int = ROWS_PER_BATCH,
               restart: bool = False, progress: list | None = None) -> DataFrame:
    """Replay a log (see :func:`replay`) and return the alerts, ``seq, sub,
    room, value``.  ``progress`` collects the observed counts."""
    out_dir = f"{workdir}/out"
    seen = replay(spark, log, workdir, lambda stream, checkpoint: start_alerts(spark, stream, out_dir, checkpoint),
                  rows_per_batch, restart)
    if seen is None:
        return spark.createDataFrame([], "seq long, sub int, room string, value string")
    if progress is not None:
        got = [p["observedMetrics"]["alerts"] for p in seen if "alerts" in p.get("observedMetrics", {})]
        progress += [{k: m[k] for k in ("alerts", "recoveries")} for m in got]
    return spark.read.schema(_ALERT).parquet(out_dir).select(F.col("ts").alias("seq"), "sub", "room", "value")


def replay_updates(spark: SparkSession, log: DataFrame, workdir: str, kinds: tuple[str, ...] = KINDS,
                   rows_per_batch: int = ROWS_PER_BATCH, restart: bool = False) -> DataFrame:
    """Replay a log and return the updates of these kinds, ``seq, sub, room,
    kind, cap, cnt, value``; the sink has a folder per kind."""
    out_dir = f"{workdir}/updates"
    cols = "sub int, room string, kind string, cap int, cnt long, value string"

    def begin(stream, checkpoint):
        return start(observed(room_stream(observed_log(stream), kinds)), checkpoint, path=out_dir,
                     partition_by=("kind",))

    if replay(spark, log, workdir, begin, rows_per_batch, restart) is None:
        return spark.createDataFrame([], f"seq long, {cols}")
    return spark.read.schema(_ROOM_UPDATE).parquet(out_dir) \
        .select(F.col("ts").alias("seq"), "sub", "room", "kind", "cap", "cnt", "value")
