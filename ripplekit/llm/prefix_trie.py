"""Prefix trie of conversations: what conversations share from their start.

A node is a distinct sequence of first turns; its members are the
conversations that start with it.  Nodes are told apart by running 128-bit
sums of hashes of (depth, turn), so no sequence is ever put together.

Totals of subtrees (leaves, tokens saved) are found by time-forward
processing:

1. *Cut.*  Nodes of more than ``limit`` members are the top of the trie.
   As ``limit`` follows the number of turns, the top has at most ``TOP_NODES``
   nodes and the root at every corpus size.  Below it hang subtrees of at most
   ``limit`` conversations, dealt to shards by a hash of their root.
2. *Shards.*  A shard's nodes are sorted by reverse level order (Spark's
   external sort) and streamed past a priority queue: a node takes the
   messages of its children, which stand in front of it, and sends its own
   total forward to its parent.  A full queue spills sorted runs.  Totals of
   shard roots leave the shard as messages.
3. *Shard roots.*  Messages are added up per parent, and the top of the trie is
   processed in the same way.

A node with one member has one leaf below it and saves nothing: of the tails
of conversations, which are most of all turns, only the first node sends a
message, and they are not sorted.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.llm.common import spill_file
from ripplekit.plans.lineage import materialize
from ripplekit.plans.ordered import Scan, ordered_scan

GROUP = 100             # conversations that share the first turns of one of them
SHARED = 6              # of which they take this many less one at most
TOP_NODES = 1 << 17     # nodes above the shards at most, next to the root
LEAST_LIMIT = 1024      # members of a shard's root at least, before it counts as top
QUEUE = 200_000         # messages that a priority queue holds in memory
CHUNK = 50_000          # ids that are joined to one text

KEY = ["depth", "s0", "s1", "s2", "s3"]   # of a node
_LANES = range(4)
_EMPTY_SHA = hashlib.sha256().hexdigest()


# -- conversations and their nodes ----------------------------------------------

def own_turns(conversations: DataFrame) -> DataFrame:
    """``c, pos, t, chars``: turns in order from 1, with a hash of role and
    text and the code points of the text; written."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), "turn", role.alias("role"),
        F.md5(F.concat(F.length(role), F.lit(":"), role, text)).alias("t"),
        F.length(text).cast("long").alias("chars"))
    placed = ordered_scan(turns, ["c"], ["turn", "role", "t"], [Scan("pos", "sum", F.lit(1).cast("long"))])
    return materialize(placed.select("c", "pos", "t", "chars"), "trie-turns")


def rebuilt_turns(own: DataFrame) -> DataFrame:
    """``c, depth, t, chars`` of the rebuilt conversations: the first ``h``
    turns of the group's first conversation, then the own turns behind the
    first ``h``."""
    c, h = F.col("c"), F.crc32(F.col("c").cast("string")) % SHARED
    base = c - c % GROUP
    first = own.where((c % GROUP == 0) & (F.col("pos") < SHARED)) \
        .select(c.alias("base"), F.col("pos").alias("depth"), "t", "chars")
    convs = own.select("c").distinct().select("c", base.alias("base"), h.alias("h"))
    shared = convs.join(first, "base").where("depth <= h").select("c", "depth", "t", "chars")
    n_first = first.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    rest = own.select("*", base.alias("base"), h.alias("h")).where("pos > h").join(n_first, "base", "left") \
        .select("c", (F.least("h", F.coalesce("n", F.lit(0))) + F.col("pos") - F.col("h")).alias("depth"), "t", "chars")
    return shared.unionByName(rest)


def prefixes(rebuilt: DataFrame) -> DataFrame:
    """``c, depth, s0..s3, p0..p3, chars``: each turn with the key of its node
    and of the node above; written."""
    hashes = [F.xxhash64("depth", "t"), F.xxhash64("depth", "t", F.lit("second"))]
    lanes = [x for h in hashes for x in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF)))]
    turns = rebuilt.select("c", "depth", "chars", *[x.alias(f"l{i}") for i, x in enumerate(lanes)])
    sums = ordered_scan(turns, ["c"], ["depth"], [Scan(f"s{i}", "sum", F.col(f"l{i}")) for i in _LANES])
    return materialize(sums.select("c", "depth", *[f"s{i}" for i in _LANES],
                                   *[(F.col(f"s{i}") - F.col(f"l{i}")).alias(f"p{i}") for i in _LANES], "chars"),
                       "trie-prefixes")


def trie_nodes(rows: DataFrame) -> DataFrame:
    """One row per node below the root: key, the key above, smallest member,
    members, code points of the last text; written."""
    return materialize(rows.groupBy(*KEY).agg(
        *[F.min(f"p{i}").alias(f"p{i}") for i in _LANES], F.min("c").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars")), "trie-nodes")


# -- digests of the conversations that end at a node -----------------------------

def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(schema),
                                                                      schema.types)], schema=schema)


def _chunks(most: int):
    """Ids of sorted rows joined by commas, a row per node and chunk."""
    def run(batches):
        key, ids, out = None, [], []
        for b in batches:
            for *k, c in zip(*(b.column(x).to_pylist() for x in [*KEY, "c"])):
                if ids and (k != key or len(ids) == most):
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                    ids = []
                key = k
                ids.append(c)
            yield _batch(out, _CHUNK_ARROW)
            out = []
        if ids:
            yield _batch([(*key, ids[0], ",".join(map(str, ids)))], _CHUNK_ARROW)
    return run


def _digests(batches):
    key, sha, out = None, None, []
    for b in batches:
        for *k, ids in zip(*(b.column(x).to_pylist() for x in [*KEY, "ids"])):
            if k != key:
                if sha is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = k, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield _batch(out, _SHA_ARROW)
        out = []
    if sha is not None:
        yield _batch([(*key, sha.hexdigest())], _SHA_ARROW)


_KEY_ARROW = [(k, pa.int64()) for k in KEY]
_CHUNK_ARROW = pa.schema([*_KEY_ARROW, ("first", pa.int64()), ("ids", pa.string())])
_SHA_ARROW = pa.schema([*_KEY_ARROW, ("sha", pa.string())])
_KEY_SQL = ", ".join(f"{k} long" for k in KEY)


def end_digests(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``depth, s0..s3, sha``: SHA-256 of the ascending ids ``c`` that end at a
    node, joined by commas.  Ids are joined to chunks where they lie by range;
    a node's chunks are then streamed through the digest, so a node where
    very many conversations end takes no memory."""
    chunks = ends.repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c") \
        .select(*KEY, "c").mapInArrow(_chunks(chunk), _KEY_SQL + ", first long, ids string")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "ids") \
        .mapInArrow(_digests, _KEY_SQL + ", sha string")


# -- time-forward processing ------------------------------------------------------

class SpillingQueue:
    """Priority queue of records of ``width`` integers.  With ``limit`` records
    in memory these become a sorted run in a nameless file in Spark's own
    spill folder; of a run only a block is in memory."""

    BLOCK = 4096

    def __init__(self, width: int, limit: int = QUEUE):
        self.width, self.limit = width, limit
        self.heap: list[tuple] = []     # records; behind each the number of its run, or -1
        self.in_memory, self.runs = 0, []

    def push(self, record: tuple) -> None:
        heapq.heappush(self.heap, (*record, -1))
        self.in_memory += 1
        if self.in_memory >= self.limit:
            self._spill()

    def _spill(self) -> None:
        mine = sorted(r[:-1] for r in self.heap if r[-1] < 0)
        self.heap = [r for r in self.heap if r[-1] >= 0]
        heapq.heapify(self.heap)
        file = spill_file()
        file.write(np.array(mine, "<i8").tobytes())
        file.seek(0)
        self.runs.append(self._records(file))
        self.in_memory = 0
        self._advance(len(self.runs) - 1)

    def _records(self, file):
        size = 8 * self.width
        with file:
            while block := file.read(size * self.BLOCK):
                yield from map(tuple, np.frombuffer(block, "<i8").reshape(-1, self.width).tolist())

    def _advance(self, run: int) -> None:
        record = next(self.runs[run], None)
        if record is not None:
            heapq.heappush(self.heap, (*record, run))

    def take(self, key: tuple):
        """Remove and yield the records that start with ``key``."""
        while self.heap and self.heap[0][:len(key)] == key:
            *record, run = heapq.heappop(self.heap)
            if run < 0:
                self.in_memory -= 1
            else:
                self._advance(run)
            yield record


_TOTALS = ["conv_id", "depth", "parent_conv_id", "n_children", "n_leaves", "saved_tokens"]
_TOTALS_SQL = ", ".join(f"{c} long" for c in _TOTALS) + ", is_root boolean"


def _forward(limit: int):
    """Nodes in reverse level order in, nodes with their totals out."""
    def run(batches):
        queue = SpillingQueue(4, limit)
        for b in batches:
            cols = {c: b.column(c).to_pylist() for c in b.schema.names}
            children, leaves, saved = cols["children"], cols["leaves"], cols["saved"]
            for i, (depth, conv) in enumerate(zip(cols["depth"], cols["conv_id"])):
                for _, _, below, tokens in queue.take((-depth, -conv)):
                    children[i] += 1
                    leaves[i] += below
                    saved[i] += tokens
                leaves[i] = leaves[i] or 1
                if not cols["is_root"][i]:
                    queue.push((1 - depth, -cols["parent_conv_id"][i], leaves[i], saved[i]))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(cols[c], pa.int64()) for c in ("conv_id", "depth", "parent_conv_id")),
                 *(pa.array(x, pa.int64()) for x in (children, leaves, saved)), b.column("is_root")],
                names=[*_TOTALS, "is_root"])
    return run


def _with_messages(nodes: DataFrame, messages: DataFrame) -> DataFrame:
    """Nodes with the totals that children outside their shard have sent."""
    sums = messages.groupBy("conv_id", "depth").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
    got = lambda c: F.coalesce(F.col(c), F.lit(0))
    return nodes.join(sums, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "is_root", *[c for c in nodes.columns if c == "cut"],
        got("children").alias("children"), got("leaves").alias("leaves"),
        (got("saved") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved"))


def _to_parent(rows: DataFrame, leaves: Column, saved: Column) -> DataFrame:
    return rows.select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"),
                       F.lit(1).cast("long").alias("children"), leaves.alias("leaves"), saved.alias("saved"))


def subtree_totals(multi: DataFrame, single_tops: DataFrame, cuts: DataFrame, limit: int,
                   queue: int = QUEUE) -> DataFrame:
    """``conv_id, depth, n_children, n_leaves, saved_tokens`` of the nodes of
    several members and of the root.  ``single_tops``: nodes of one member
    below them; ``cuts``: ``conv_id, cut``, the shard root on a conversation's
    path."""
    is_top = (F.col("n_convs") > limit) | (F.col("depth") == 0)
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    tails = _to_parent(single_tops, one, none)
    light = multi.where(~is_top).join(cuts, "conv_id").withColumn("is_root", F.col("parent_convs") > limit) \
        .withColumn("is_root", F.col("is_root") | (F.col("depth") == 1))
    low_first = [F.desc("depth"), F.desc("conv_id")]
    shards = _with_messages(light, tails).repartition("cut").sortWithinPartitions(*low_first).drop("cut") \
        .mapInArrow(_forward(queue), _TOTALS_SQL)
    shards = materialize(shards, "trie-shards")
    roots = _to_parent(shards.where("is_root"), F.col("n_leaves"), F.col("saved_tokens"))
    top = multi.where(is_top).withColumn("is_root", F.col("depth") == 0)
    top = _with_messages(top, tails.unionByName(roots)).repartition(1).sortWithinPartitions(*low_first) \
        .mapInArrow(_forward(queue), _TOTALS_SQL)
    cols = ["conv_id", "depth", "n_children", "n_leaves", "saved_tokens"]
    return shards.select(*cols).unionByName(top.select(*cols))


def prefix_trie(conversations: DataFrame, limit: int | None = None, queue: int = QUEUE,
                chunk: int = CHUNK) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``, a row per node of the rebuilt conversations.

    Turns go by number, null first; of equal numbers by role and then by the
    MD5 of length of role, role and text (so equal turns are interchangeable).
    A null role or text is empty; rows without a ``conv_id`` are left out;
    repeated rows are turns of their own; a remainder has the sign of its
    number, as in SQL; other columns are not read; an empty table gives an
    empty result.  ``limit`` is the number of members up to which a node lies
    in a shard; by default it follows the number of turns."""
    own = own_turns(conversations)
    rows = prefixes(rebuilt_turns(own))
    nodes = trie_nodes(rows)
    convs = own.select("c").distinct()
    size = convs.agg(F.min("c").alias("least"), F.count(F.lit(1)).alias("n")).first()
    if not size["n"]:
        return conversations.sparkSession.createDataFrame(
            [], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                "saved_tokens long, ends_sha256 string")
    limit = limit or max(LEAST_LIMIT, -(-rows.count() // TOP_NODES))

    # Every conversation's last node, and its first node below the top.  The
    # top has at most turns / limit nodes, TOP_NODES at most: small enough to
    # be sent to every task.
    top_keys = nodes.where(F.col("n_convs") > limit).select(*KEY, F.lit(True).alias("top"))
    node = F.struct(*KEY)
    paths = rows.join(F.broadcast(top_keys), KEY, "left").groupBy("c").agg(
        F.max_by(node, "depth").alias("last"),
        F.min_by(F.xxhash64(*KEY), F.when(F.col("top").isNull(), F.col("depth"))).alias("cut"))
    paths = materialize(convs.join(paths, "c", "left"), "trie-paths")
    at_root = F.struct(*[F.lit(0).cast("long").alias(k) for k in KEY])
    digests = materialize(end_digests(materialize(
        paths.select(F.coalesce("last", at_root).alias("k"), "c").select("k.*", "c"), "trie-ends"), chunk),
        "trie-digests")

    # Nodes with the smallest member and the members of the node above.
    above = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(f"s{i}").alias(f"p{i}") for i in _LANES],
                         F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_convs"))
    deep = nodes.where("depth > 1").join(above, ["depth", *[f"p{i}" for i in _LANES]])
    shallow = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(size["least"]).cast("long")) \
        .withColumn("parent_convs", F.lit(size["n"]).cast("long"))
    long = lambda v: F.lit(v).cast("long")
    root = conversations.sparkSession.range(1).select(
        *[long(0).alias(k) for k in KEY], long(size["least"]).alias("conv_id"), long(size["n"]).alias("n_convs"),
        long(0).alias("chars"), long(None).alias("parent_conv_id"), long(None).alias("parent_convs"))
    cols = [*KEY, "conv_id", "n_convs", "chars", "parent_conv_id", "parent_convs"]
    every = deep.select(*cols).unionByName(shallow.select(*cols)).unionByName(root) \
        .join(digests, KEY, "left").drop("s0", "s1", "s2", "s3")
    every = materialize(every, "trie-tree")

    multi = every.where("n_convs > 1 or depth = 0")
    single = every.where("n_convs = 1 and depth > 0")
    totals = subtree_totals(multi, single.where("parent_convs > 1 or depth = 1"),
                            paths.select(F.col("c").alias("conv_id"), "cut"), limit, queue)
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    sha = F.coalesce("sha", F.lit(_EMPTY_SHA)).alias("ends_sha256")
    tails = single.withColumn("n_children", F.col("sha").isNull().cast("long")) \
        .withColumn("n_leaves", long(1)).withColumn("saved_tokens", long(0))
    return multi.join(totals, ["conv_id", "depth"]).select(*out, sha).unionByName(tails.select(*out, sha))
