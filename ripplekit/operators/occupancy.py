"""Occupancy of rooms from two changelog tables, as batch jobs.

Input is one log ``seq long, src string, key string, val string`` holding
both upsert tables: ``src='student'`` (key student, val room) and
``src='class'`` (key room, val capacity); a null ``val`` deletes the key.
``seq`` totally orders the log.

Semantics, update by update (the cache of the streaming original is off, so
every update is visible downstream):

* a student's move first takes one from the old room (``sub = 0``), then
  adds one to the new room (``sub = 1``); re-sending the same room gives
  both updates, a delete only the first;
* a room's count exists from its first student on and stays at 0;
* a capacity update replaces the capacity, a null deletes it;
* every count or capacity update of a room that has both gives a joined
  row ``(cap, cnt)`` (C3); deletions reach no one downstream;
* the alert (C4) of a joined row is the count when ``cnt > cap``; ``OK``
  when the previous joined row of the room was over capacity with a larger
  count; nothing otherwise.  So an overloaded room alerts on every update
  and a recovery gives one ``OK``.

All per-key order runs through ``plans.ordered.ordered_scan``, whose window
partitions are bounded, so one hot student or room does not serialise the
job.  The output of one scan that feeds another is written to the checkpoint
folder first (deltas, joined updates).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.functions.strings import strict_int
from ripplekit.plans.lineage import materialize
from ripplekit.plans.ordered import Scan, ordered_scan


def latest_state(log: DataFrame, by: tuple[str, ...] = ("src", "key")) -> DataFrame:
    """The current table: newest ``val`` per key, deleted keys removed.
    ``max_by`` is a partial aggregate, so hot keys combine before the
    shuffle."""
    newest = log.groupBy(*by).agg(F.max_by(F.struct("val"), "seq").alias("_l"))
    return newest.where(F.col("_l.val").isNotNull()).select(*by, F.col("_l.val").alias("val"))


def room_deltas(log: DataFrame, partitions: int | None = None) -> DataFrame:
    """Count deltas and capacity updates per room:
    ``seq, sub, room, delta int, capu struct<cap:int>``.

    Student rows become ``-1`` on the previous room and ``+1`` on the new
    one; class rows carry ``capu = struct(cap)`` (``cap`` null = deleted)
    and delta 0."""
    students = log.where(F.col("src") == "student").select("seq", "key", "val")
    moved = ordered_scan(students, ["key"], ["seq"], [Scan("old", "lag", F.col("val"))], partitions)
    capu_null = F.lit(None).cast("struct<cap:int>")
    both = F.array(
        F.struct(F.lit(0).alias("sub"), F.col("old").alias("room"), F.lit(-1).alias("delta")),
        F.struct(F.lit(1).alias("sub"), F.col("val").alias("room"), F.lit(1).alias("delta")))
    stud = (moved.select("seq", F.explode(both).alias("d"))
            .select("seq", "d.sub", "d.room", "d.delta", capu_null.alias("capu"))
            .where(F.col("room").isNotNull()))
    caps = log.where(F.col("src") == "class").select(
        "seq", F.lit(0).alias("sub"), F.col("key").alias("room"), F.lit(0).alias("delta"),
        F.struct(strict_int(F.col("val"), "capacity").alias("cap")).alias("capu"))
    return stud.unionByName(caps)


def room_timeline(log: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every count or capacity update of a room with the room's state after
    it: ``seq, sub, room, delta, cnt long, seen long, cap int``; ``seen > 0``
    once the room has a count, ``cap`` null when no capacity is set."""
    # The deltas come out of the per-student scan: written once, so that the
    # per-room scan samples and moves a table, not the student scan.
    d = materialize(room_deltas(log, partitions), "room-deltas")
    s = ordered_scan(d, ["room"], ["seq", "sub"],
                     [Scan("cnt", "sum", F.col("delta").cast("long")),
                      Scan("seen", "sum", F.abs(F.col("delta")).cast("long")),
                      Scan("lc", "last", F.col("capu"))], partitions)
    return s.select("seq", "sub", "room", "delta", "cnt", "seen", F.col("lc.cap").alias("cap"))


def room_counts(log: DataFrame, partitions: int | None = None) -> DataFrame:
    """The count table's update stream, ``seq, sub, room, cnt``."""
    t = room_timeline(log, partitions)
    return t.where(F.col("delta") != 0).select("seq", "sub", "room", "cnt")


def room_status(log: DataFrame, partitions: int | None = None) -> DataFrame:
    """The inner join of capacities and counts, one row per update of
    either side while both exist: ``seq, sub, room, cap, cnt``."""
    return room_timeline(log, partitions).where((F.col("seen") > 0) & F.col("cap").isNotNull()) \
        .select("seq", "sub", "room", "cap", "cnt")


def alerts_from_status(status: DataFrame, partitions: int | None = None) -> DataFrame:
    """C4 on joined rows: ``seq, sub, room, value`` with ``value`` the count
    (as text) or ``OK``."""
    s = ordered_scan(status, ["room"], ["seq", "sub"],
                     [Scan("prev", "lag", F.struct("cap", "cnt"))], partitions)
    over = F.col("cnt") > F.col("cap")
    prev_over = F.col("prev.cnt") > F.col("prev.cap")
    value = (F.when(over, F.col("cnt").cast("string"))
             .when(prev_over & (F.col("prev.cnt") > F.col("cnt")), F.lit("OK")))
    return (s.select("seq", "sub", "room", value.alias("value"))
            .where(F.col("value").isNotNull()))


def alerts(log: DataFrame, partitions: int | None = None) -> DataFrame:
    """C4: overload and recovery alerts, ``seq, sub, room, value``.  The
    joined updates are written before the alert scan reads them."""
    return alerts_from_status(materialize(room_status(log, partitions), "room-status"), partitions)
