"""Exact top-k search by inner product, term at a time.

Candidates are dealt into blocks.  Inside a block every dimension is a term
with a postings list (position in the block, weight).  A query row scatters
its weights: for each of its non-zero dimensions, weight times posting is
added to a dense array of scores, one per candidate of the block.  A
partition selection takes the best of each block, and Spark merges the
blocks' winners per query.  Scores are integers, so the result is exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8192       # candidates with one score array
QUERY_BLOCK = 256  # queries scored together
SCALE = 64

_HITS = "query_id long, of_id long, vec_id long, score long"
_SAFE = 1 << 62


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``id long, v array<long>`` with floor(scale * x) of every component;
    vectors that are null or hold a null, NaN or infinite component are out."""
    x = F.col(vec_col).cast("array<double>")
    return (vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
            .where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))))
            .select("id", F.transform("x", lambda e: F.floor(F.lit(float(scale)) * e).cast("double")).alias("v")))


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and a dense matrix; shorter vectors end in zeros.  Integers of any
    size stay exact: large ones are kept as Python integers."""
    ids = table.column("id").to_numpy()
    col = table.column("v").combine_chunks()
    flat = col.flatten().to_numpy(zero_copy_only=False)
    lens = np.asarray(col.value_lengths()) if len(col) else np.zeros(0, np.int64)
    dim = int(lens.max(initial=0))
    big = len(flat) and np.abs(flat).max() ** 2 * dim >= _SAFE
    m = np.zeros((len(ids), dim), object if big else np.int64)
    rows = np.repeat(np.arange(len(ids)), lens)
    cols = np.arange(len(flat)) - np.repeat(np.cumsum(lens) - lens, lens)
    m[rows, cols] = [int(x) for x in flat] if big else flat.astype(np.int64)
    return ids, m


def _search(k):
    def run(key, queries: pa.Table, block: pa.Table) -> pa.Table:
        out_q, out_n, out_v, out_s = [], [], [], []
        qids, q = _matrix(queries)
        numbers = queries.column("of_id").to_numpy()
        ids, m = _matrix(block)
        order = np.argsort(ids, kind="stable")
        ids, m = ids[order], m[order]
        dim = min(q.shape[1], m.shape[1])
        most = (float(np.abs(q).max()) * float(np.abs(m).max()) * dim) if q.size and m.size else 0.0
        wide = m.dtype == object or q.dtype == object or most >= _SAFE
        kind = object if wide else np.int32 if most < 2**31 else np.int64
        # A term of more than half the block is kept as a full column.
        posts = [np.flatnonzero(m[:, t]) for t in range(dim)]
        posts = [p if 2 * len(p) < len(ids) else slice(None) for p in posts]
        weights = [np.ascontiguousarray(m[p, t].astype(kind)) for t, p in enumerate(posts)]
        spare = np.empty(len(ids), kind)
        for lo in range(0, len(qids) if len(ids) else 0, QUERY_BLOCK):
            part = q[lo:lo + QUERY_BLOCK].astype(kind)
            scores = np.zeros((len(part), len(ids)), kind)
            for row, dense in zip(part, scores):
                for t in np.flatnonzero(row[:dim]):
                    w = weights[t]
                    dense[posts[t]] += np.multiply(w, row[t], out=spare[:len(w)])
            for i, qid in enumerate(qids[lo:lo + QUERY_BLOCK]):
                s = scores[i]
                if wide:
                    s = np.array([max(-2**63, min(2**63 - 1, x)) for x in s], np.int64)
                at = np.flatnonzero(ids != qid)
                if len(at) > k:
                    # ties at the border go to the smaller id: ids ascend
                    edge = np.partition(s[at], len(at) - k)[-k]
                    above, level = at[s[at] > edge], at[s[at] == edge]
                    at = np.concatenate([above, level[:k - len(above)]])
                out_q.append(np.full(len(at), qid))
                out_n.append(np.full(len(at), numbers[lo + i]))
                out_v.append(ids[at])
                out_s.append(s[at])
        cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        return pa.table({"query_id": cat(out_q), "of_id": cat(out_n), "vec_id": cat(out_v), "score": cat(out_s)})
    return run


def topk_search(queries: DataFrame, candidates: DataFrame, k: int = 20, id_col: str = "vec_id",
                vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` highest integer
    inner products over all candidates but those with the query's own id;
    ties go to the smaller id.  Vectors of unequal length are compared on the
    dimensions both have; a score beyond the long range is cut to it.  Rows
    without an id or with a vector that is null or not finite take no part;
    a repeated row counts as a candidate of its own.  Queries with equal id and
    quantised vector are asked once; different vectors under one id are
    queries of their own, whose results all bear that id."""
    c = quantised(candidates, id_col, vec_col, scale)
    # the vectors under one id, few as a rule, are told apart by a hash
    q = quantised(queries, id_col, vec_col, scale).withColumn("of_id", F.xxhash64("v")).dropDuplicates(["id", "of_id"])
    n = c.count()
    n_blocks = max(1, -(-n // BLOCK))
    q_blocks = max(1, -(-q.count() // BLOCK))
    cand = c.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
    asked = (q.withColumn("part", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(q_blocks)).cast("int"))
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    cand = cand.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    hits = asked.groupBy("block", "part").cogroup(cand.groupBy("block", "part")) \
        .applyInArrow(_search(k), _HITS)
    best = Window.partitionBy("query_id", "of_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
