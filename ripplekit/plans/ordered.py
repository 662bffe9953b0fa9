"""Skew-safe ordered scans per key.

Several jobs need "previous row", "running sum" or "last non-null value so
far" per key in a total order (room occupancy, operation logs, history
zones).  A window ``partitionBy(key).orderBy(seq)`` puts every row of a key
into one task, so a key holding a third of the data would serialise a third
of the job.  The scan has one path for all keys and sizes:

1. *place*: the rows are range-partitioned by (key, order) into partitions of
   about equal size, and written with the number of their partition.  A key
   takes up a run of consecutive partitions, in order.  This reads the input
   twice: Spark samples it for the bounds, then moves it;
2. *scan*: a window over (key, partition); none has more rows than one
   partition;
3. *carry*: one summary row per (key, partition) from a map-side ``groupBy``
   (total, last row, last non-null, maximum), combined across the partitions
   of a key with a window that has at most as many rows per key as there are
   partitions, and joined back.

Keys must be non-null and the order columns must be unique within a key.
Helper columns get names that the input does not have.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplekit.plans.lineage import materialize

KINDS = ("lag", "lead", "sum", "last", "last_before", "max_before", "arg_max_before")


@dataclass(frozen=True)
class Scan:
    """One output column of :func:`ordered_scan`.

    kind:
      ``lag``          value of the previous row (null on the first row)
      ``lead``         value of the next row (null on the last row)
      ``sum``          running sum up to and including this row, nulls
                       skipped (null before the first value)
      ``last``         last non-null value up to and including this row
      ``last_before``  last non-null value strictly before this row
      ``max_before``   maximum strictly before this row
      ``arg_max_before``  ``expr`` is a struct of two fields: the row with the
                       largest first field (nulls left out) strictly before
                       this row, as that struct; of equal ones the larger
                       second field
    """

    out: str
    kind: str
    expr: Column


def ordered_scan(df: DataFrame, keys: list[str], order: list[str], specs: list[Scan],
                 partitions: int | None = None) -> DataFrame:
    """Add the columns described by ``specs`` to ``df``; see module doc.
    ``partitions`` is the number of range partitions (by default the
    session's shuffle partitions, fewer for a small input)."""
    for s in specs:
        if s.kind not in KINDS:
            raise ValueError(f"unknown scan kind {s.kind!r}")
    prefix = "_"   # of helper columns: none that the input has
    while any(c.lower().startswith((f"{prefix}part", *(f"{prefix}{x}{i}" for x in "eslc" for i in range(len(specs)))))
              for c in df.columns):
        prefix += "_"
    part, name = f"{prefix}part", lambda x, i: f"{prefix}{x}{i}"
    base = df.select("*", *[s.expr.alias(name("e", i)) for i, s in enumerate(specs)])
    ranged = base.repartitionByRange(partitions, *keys, *order) if partitions \
        else base.repartitionByRange(*keys, *order)
    placed = materialize(ranged.select("*", F.spark_partition_id().alias(part)), "ordered")

    w = Window.partitionBy(*keys, part).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    at = F.struct(*[F.col(c) for c in order])
    # The values before (for lead: after) a partition, over its key's partitions.
    wk = Window.partitionBy(*keys).orderBy(part)
    past = wk.rowsBetween(Window.unboundedPreceding, -1)

    cols, aggs, carries = [], [], []
    for i, s in enumerate(specs):
        e, summary = F.col(name("e", i)), F.col(name("s", i))
        if s.kind == "arg_max_before":   # a struct with a null first field does not take part
            first = base.schema[name("e", i)].dataType.fieldNames()[0]
            e = F.when(e.getField(first).isNotNull(), e)
        row = F.struct(e.alias("v"))
        non_null = F.max_by(e, F.when(e.isNotNull(), at))
        local, total, carry = {
            "lag": lambda: (F.lag(row).over(w), F.max_by(row, at), F.lag(summary).over(wk)),
            "lead": lambda: (F.lead(row).over(w), F.min_by(row, at), F.lead(summary).over(wk)),
            "sum": lambda: (F.sum(e).over(upto), F.sum(e), F.sum(summary).over(past)),
            "last": lambda: (F.last(e, ignorenulls=True).over(upto), non_null,
                             F.last(summary, ignorenulls=True).over(past)),
            "last_before": lambda: (F.last(e, ignorenulls=True).over(before), non_null,
                                    F.last(summary, ignorenulls=True).over(past)),
            "max_before": lambda: (F.max(e).over(before), F.max(e), F.max(summary).over(past)),
            "arg_max_before": lambda: (F.max(e).over(before), F.max(e), F.max(summary).over(past)),
        }[s.kind]()
        cols.append(local.alias(name("l", i)))
        aggs.append(total.alias(name("s", i)))
        carries.append(carry.alias(name("c", i)))
    scanned = placed.select("*", *cols)
    carry = placed.groupBy(*keys, part).agg(*aggs).select(*keys, part, *carries)
    joined = scanned.join(carry, on=[*keys, part])

    out = []
    for i, s in enumerate(specs):
        local, carried = F.col(name("l", i)), F.col(name("c", i))
        if s.kind in ("lag", "lead"):
            v = F.coalesce(local, carried).getField("v")
        elif s.kind == "sum":
            v = F.coalesce(local + carried, local, carried)
        elif s.kind in ("max_before", "arg_max_before"):
            v = F.greatest(local, carried)
        else:
            v = F.coalesce(local, carried)
        out.append(v.alias(s.out))
    return joined.select(*[F.col(c) for c in df.columns], *out)
