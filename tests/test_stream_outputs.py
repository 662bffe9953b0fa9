"""Tagged side outputs, durable state, the monitor and the batch sink of the
occupancy stream."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from conftest import rows
from ripplekit.operators import occupancy
from ripplekit.plans.lineage import scratch_path
from ripplekit.streaming import occupancy as stream
from ripplekit.streaming import state
from ripplekit.streaming.batch_table import BatchTable
from ripplekit.streaming.monitor import UpdateMonitor, monitored
from test_stream import LOG, random_log

TABLE = "ts long, sub int, room string, value string"


@pytest.mark.parametrize("restart", [False, True])
@pytest.mark.parametrize("size", [45, 1000])
def test_streamed_updates_equal_batch(spark, restart, size):
    log = spark.createDataFrame(random_log(size + restart), LOG)
    got = stream.replay_updates(spark, log, scratch_path(spark, "updates"), rows_per_batch=size, restart=restart)
    for kind, want in (("count", occupancy.room_counts(log)), ("joined", occupancy.room_status(log)),
                       ("alert", occupancy.alerts(log))):
        cols = want.columns
        assert rows(got.where(F.col("kind") == kind), *cols) == rows(want) and want.count() > 10


def test_kinds(spark):
    log = spark.createDataFrame(random_log(4, 80), LOG)
    got = stream.replay_updates(spark, log, scratch_path(spark, "kinds"), kinds=("joined",))
    assert {r.kind for r in got.collect()} == {"joined"}
    with pytest.raises(ValueError, match="kinds"):
        stream.room_stream(log, ("nothing",))
    empty = stream.replay_updates(spark, spark.createDataFrame([], LOG), scratch_path(spark, "none"))
    assert empty.count() == 0 and "kind" in empty.columns


def test_state_is_read_back(spark):
    """The state equals the batch tables, at the end and as of a micro-batch."""
    log = spark.createDataFrame(random_log(11, 200), LOG)
    work = scratch_path(spark, "state")
    stream.replay_log(spark, log, work, rows_per_batch=50)
    checkpoint = f"{work}/checkpoint"

    def want(part):
        last = occupancy.room_counts(part).groupBy("room").agg(F.max_by("cnt", F.struct("seq", "sub")).alias("n"))
        return sorted(rows(occupancy.latest_state(part), "src", "key", "val")
                      + [("count", r.room, str(r.n)) for r in last.collect()])

    assert rows(state.latest_tables(spark, checkpoint)) == want(log)
    # the rows of the first two files, which the first two micro-batches took
    first = stream.LOG_SCHEMA
    staged = spark.read.schema(first).parquet(f"{work}/in/*").select(
        F.col("ts").alias("seq"), "src", "key", "val", F.input_file_name().alias("f"))
    files = sorted({r.f for r in staged.select("f").distinct().collect()})
    early = staged.where(F.col("f").isin(files[:2])).drop("f")
    assert rows(state.latest_tables(spark, checkpoint, batch=1)) == want(early) != want(log)
    assert set(state.operator_ids(spark, checkpoint)) == {"applyInPandasWithState", "transformWithStateInPandasExec"}


def test_keys_share_few_groups(spark, monkeypatch):
    """Groups, which Python is called for, are as many as buckets, not keys;
    keys that share one, and a student and a room without a name, stay apart."""
    monkeypatch.setattr(stream, "BUCKETS", 2)
    log = random_log(17, 160) + [(200, "student", None, "R1"), (201, "class", None, "1"), (202, "student", "s1", "R2"),
                                 (203, "student", None, None), (204, "student", "s99", "R1")]
    log = spark.createDataFrame(log, LOG)
    work = scratch_path(spark, "buckets")
    got = stream.replay_updates(spark, log, work, rows_per_batch=45)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"
    for kind, want in (("count", occupancy.room_counts(log.where("key IS NOT NULL"))),
                       ("alert", occupancy.alerts(log.where("key IS NOT NULL")))):
        extra = {(200, 1, "R1"), (203, 0, "R1")}
        counted = [r for r in rows(got.where(F.col("kind") == kind), *want.columns) if r[:3] not in extra]
        assert [r for r in counted if r[0] < 200] == [r for r in rows(want) if r[0] < 200]
    moved = got.where("kind = 'count' AND seq >= 200").select("seq", "sub", "room")
    assert {(200, 1, "R1"), (203, 0, "R1"), (204, 1, "R1")} <= set(rows(moved))
    for operator, number in state.operator_ids(spark, f"{work}/checkpoint").items():
        options = {"stateVarName": "rooms"} if operator.startswith("transform") else {}
        kept = spark.read.format("statestore").option("operatorId", number).options(**options) \
            .load(f"{work}/checkpoint")
        assert 1 <= kept.count() <= 2
    assert state.rooms(spark, f"{work}/checkpoint").where("room IS NULL AND cap = 1 AND NOT seen").count() == 1


def test_partitions_follow_the_micro_batch(spark):
    """State partitions are opened in every micro-batch: not more of them than
    the cores can use, however large the input's own shuffles are."""
    cores = spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.shuffle.partitions")
    work = scratch_path(spark, "partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(50 * cores))
    try:
        stream.replay_log(spark, spark.createDataFrame(random_log(3, 40), LOG), work)
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(50 * cores)
        meta = spark.read.format("state-metadata").load(f"{work}/checkpoint")
        assert {r.numPartitions for r in meta.collect()} == {2 * cores}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_monitor_counts_every_micro_batch(spark):
    """Many micro-batches, two runs on one checkpoint, and no more progress
    reports kept than one."""
    log = spark.createDataFrame(random_log(21, 240), LOG)
    work, runs = scratch_path(spark, "monitor"), []

    def begin(part, checkpoint):
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
        updates = stream.observed(stream.room_stream(stream.observed_log(part)))
        runs.append(stream.start(updates, checkpoint, path=f"{work}/out", partition_by=("kind",)))
        return runs[-1]

    with monitored(spark) as monitor:
        seen = stream.replay(spark, log, work, begin, rows_per_batch=20, restart=True)
        for q in runs:
            monitor.wait(q.runId)
    assert len(seen) <= 2 == len(runs) and runs[0].id == runs[1].id
    totals = monitor.totals(runs[0].id)
    alerts = occupancy.alerts(log)
    assert totals["log"] == {"student": log.where("src = 'student'").count(),
                             "capacity": log.where("src = 'class'").count()}
    assert totals["updates"] == {"count": occupancy.room_counts(log).count(),
                                 "joined": occupancy.room_status(log).count(), "alert": alerts.count(),
                                 "recovery": alerts.where("value = 'OK'").count()}
    assert monitor.totals("unknown") == {}


def test_monitor_counts_a_batch_once():
    monitor = UpdateMonitor()
    for batch, n in ((0, 1), (1, 2), (1, 2), (2, None)):
        monitor.add("q", batch, {"m": {"a": n}})
    monitor.add("q", 3, {})
    assert monitor.totals("q") == {"m": {"a": 3}}
    with pytest.raises(TimeoutError):
        monitor.wait("run", 0.01)


class Broken(BatchTable):
    """Fails once at a micro-batch, before or after the commit."""

    def __init__(self, *args, at, after):
        super().__init__(*args)
        self.at, self.after, self.commits = at, after, []

    def commit(self, staging, batch):
        self.commits.append(batch)
        fails, self.at = batch == self.at, None if batch == self.at else self.at
        if fails and not self.after:
            raise RuntimeError("lost before the commit")
        super().commit(staging, batch)
        if fails:
            raise RuntimeError("lost after the commit")


@pytest.mark.parametrize("after", [False, True])
def test_replayed_batch_changes_nothing(spark, after):
    log = spark.createDataFrame(random_log(31, 200), LOG)
    want = rows(occupancy.alerts(log))
    work = scratch_path(spark, "broken")
    table = Broken(spark, f"{work}/table", TABLE, at=1, after=after)

    def begin(part, checkpoint):
        alerts = stream.alerts_stream(part).select("ts", "sub", "room", "value")
        return stream.start(alerts, checkpoint, each_batch=table.each_batch)

    with pytest.raises(StreamingQueryException, match="lost"):
        stream.replay(spark, log, work, begin, rows_per_batch=50)
    assert table.committed(0) and table.committed(1) == after and not table.committed(2)
    q = begin(spark.readStream.schema(stream.LOG_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{work}/in/*"),
              f"{work}/checkpoint")
    q.awaitTermination()
    assert table.commits == ([0, 1, 2, 3] if after else [0, 1, 1, 2, 3])
    assert rows(table.read(), "ts", "sub", "room", "value") == want
    # a committed micro-batch that comes again is not written
    assert not table.write(table.read().limit(1).drop("batch"), 1)
    assert rows(table.read(), "ts", "sub", "room", "value") == want
    table.drop_staging()
    newest = {r.room: r.value for r in table.latest(["room"], ["ts", "sub"]).collect()}
    assert newest == {room: value for _, _, room, value in sorted(want)}


def test_batch_table_belongs_to_one_query(spark):
    table = BatchTable(spark, f"{scratch_path(spark, 'owned')}/t", "id long")
    assert table.write(spark.range(3), 0, "first")
    assert table.write(spark.range(2), 1, "first") and not table.write(spark.range(9), 1, "first")
    with pytest.raises(ValueError, match="first"):
        table.write(spark.range(1), 2, "second")
    assert table.read().count() == 5
