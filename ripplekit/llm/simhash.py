"""SimHash near-duplicates by the generalised pigeonhole principle.

1. *Fingerprints.*  XXH64 (seed 42) of every word shingle, repeats included;
   a bit of the 64-bit fingerprint is set if it is set in over half of them.
2. *Partitions.*  A 64 x 64 table of how often bits agree, summed over all
   distinct fingerprints, groups correlated bits into ``parts`` partitions.
3. *Thresholds.*  Two fingerprints within ``distance`` bits differ by at most
   t_i bits in some partition i, for any t with sum(t_i + 1) = distance + 1
   (t_i = -1 skips the partition).  For each fingerprint dynamic programming
   picks the t with the fewest expected probes and candidates, estimated
   from counts of the leading bits of every partition.
4. *Probe and verify.*  Every fingerprint is indexed under its value in each
   partition and probes all values within t_i bits.  Fingerprints that meet
   are compared on all 64 bits, and each meeting place passes on a spanning
   forest of its links, not its pairs.  Where more than ``MEET`` fingerprints
   meet, two of them are within two bits exactly if they share one of their
   values with at most one bit flipped (generally: half the distance), so
   these values are the meeting places instead, each of bounded size.
5. *Components* of the links give the classes (``components.py``).
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.llm import common as C
from ripplekit.llm.components import components
from ripplekit.plans.lineage import materialize

BITS = 64
LEAD = 10        # leading bits of a partition that the estimates count
MEET = 1024      # fingerprints that are compared pair by pair in one place
PROBE_COST = 1.0  # of one probe, in candidates


def _shingle_hashes(text: bytes, n: int) -> list[int]:
    words = text.lower().split()   # bytes.lower() changes A-Z only
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) < n:
        return [xxhash.xxh64_intdigest(joined, 42)]
    h = xxhash.xxh64_intdigest
    return [h(joined[a:b], 42) for a, b in zip(starts[:len(words) - n + 1].tolist(), ends[n - 1:].tolist())]


def fingerprint(text: bytes, n: int) -> int:
    """Fingerprint of one text as an unsigned integer."""
    hs = np.array(_shingle_hashes(text, n), dtype="<u8")
    if not len(hs):
        return 0
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(hs), 1 << 18):
        part = hs[lo:lo + (1 << 18)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little") \
            .sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hs), bitorder="little").view("<u8")[0])


def simhash(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, fp long, text_hash long`` (the 64 bits as a signed
    number, and ``common.text_hash``)."""
    def run(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.array(fps, np.uint64).view(np.int64)), b.column("text_hash")],
                names=["doc_id", "fp", "text_hash"])
    return C.id_and_text(docs, id_col, text_col).withColumn("text_hash", C.text_hash()) \
        .mapInArrow(run, "doc_id long, fp long, text_hash long")


# -- partitions and thresholds --------------------------------------------------

def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def correlations(fps: DataFrame) -> np.ndarray:
    """Bit correlations over all rows; 4,096 sums reach the driver."""
    def run(batches):
        both, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            x = _bits(b.column("fp").to_numpy().view(np.uint64)).astype(np.float64)
            both += x.T @ x
            n += len(x)
        i, j = np.divmod(np.arange(BITS * BITS), BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(j), pa.array(both.ravel().astype(np.int64)),
             pa.array(np.where(i == j, n, 0))], names=["i", "j", "both", "n"])
    rows = (fps.select("fp").mapInArrow(run, "i long, j long, both long, n long")
            .groupBy("i", "j").agg(F.sum("both").alias("both"), F.sum("n").alias("n")).collect())
    both, n = np.zeros((BITS, BITS)), 1
    for r in rows:
        both[r.i, r.j] = r.both
        n = max(n, r.n)
    p = np.diag(both) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    return (both / n - np.outer(p, p)) / np.outer(sd, sd)


def partition_bits(corr: np.ndarray, parts: int) -> list[list[int]]:
    """Greedy groups of equal size: each starts at the lowest free bit and
    takes the bit most correlated with those that it has."""
    free, groups = set(range(BITS)), []
    strength = np.abs(corr)
    for g in range(parts):
        size = (BITS - g + parts - 1) // parts
        group = [min(free)]
        free.remove(group[0])
        while len(group) < size:
            nxt = max(sorted(free), key=lambda b: strength[b, group].sum())
            group.append(nxt)
            free.remove(nxt)
        groups.append(group)
    return groups


def _part_values(fps: np.ndarray, group: list[int]) -> np.ndarray:
    v = np.zeros(len(fps), np.int64)
    for k, b in enumerate(group):
        v |= ((fps >> np.uint64(b)) & np.uint64(1)).astype(np.int64) << k
    return v


def _lead_counts(fps: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """Rows by leading bits of each partition: ``parts * 2^LEAD`` counts."""
    def run(batches):
        counts = [np.zeros(1 << LEAD, np.int64) for _ in groups]
        for b in batches:
            x = b.column("fp").to_numpy().view(np.uint64)
            for c, g in zip(counts, groups):
                c += np.bincount(_part_values(x, g[:LEAD]), minlength=1 << LEAD)
        at = [np.flatnonzero(c) for c in counts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(groups)), [len(a) for a in at])),
             pa.array(np.concatenate(at).astype(np.int64)),
             pa.array(np.concatenate([c[a] for c, a in zip(counts, at)]))], names=["part", "lead", "n"])
    out = [np.zeros(1 << LEAD) for _ in groups]
    for r in (fps.select("fp").mapInArrow(run, "part long, lead long, n long")
              .groupBy("part", "lead").agg(F.sum("n").alias("n")).collect()):
        out[r.part][r.lead] = r.n
    return out


def _costs(counts: np.ndarray, width: int, most: int) -> np.ndarray:
    """``[t + 1, lead]``: expected probes and candidates of threshold t."""
    lead = min(LEAD, width)
    rest = width - lead
    x = np.arange(1 << LEAD)
    near = [np.zeros(1 << LEAD) for _ in range(most + 1)]
    for d in range(min(most, lead) + 1):
        for flip in combinations(range(lead), d):
            near[d] += counts[x ^ sum(1 << f for f in flip)]
    cost = np.zeros((most + 2, 1 << LEAD))
    for t in range(most + 1):
        probes = sum(comb(width, k) for k in range(t + 1))
        cand = sum(near[j] * sum(comb(rest, k) for k in range(t - j + 1)) / 2**rest for j in range(t + 1))
        cost[t + 1] = PROBE_COST * probes + cand
    return cost


def thresholds(costs: np.ndarray, distance: int) -> np.ndarray:
    """``costs[part, t + 1, row]`` -> ``t[part, row]`` of least total cost with
    sum(t + 1) = distance + 1, by dynamic programming over the partitions."""
    parts, _, n = costs.shape
    need = distance + 1
    best = np.full((need + 1, n), np.inf)
    best[0] = 0
    took = np.zeros((parts, need + 1, n), np.int64)
    for i in range(parts):
        new = np.full((need + 1, n), np.inf)
        for k in range(need + 1):
            for a in range(k + 1):
                c = best[k - a] + costs[i, a]
                better = c < new[k]
                new[k][better], took[i, k][better] = c[better], a
        best = new
    left = np.full(n, need)
    t = np.zeros((parts, n), np.int64)
    for i in reversed(range(parts)):
        a = took[i, left, np.arange(n)]
        t[i], left = a - 1, left - a
    return t


# -- probe and verify -------------------------------------------------------------

def _meetings(groups, costs, distance):
    """Index and probe rows ``place long, fp long``; a place is a partition
    and a value."""
    def run(batches):
        for b in batches:
            signed = b.column("fp").to_numpy()
            x = signed.view(np.uint64)
            values = [_part_values(x, g) for g in groups]
            lead = [v & ((1 << LEAD) - 1) for v in values]
            t = thresholds(np.stack([c[:, ld] for c, ld in zip(costs, lead)]), distance)
            places, fps = [], []
            for i, (g, v) in enumerate(zip(groups, values)):
                places.append(v | i << 40)
                fps.append(signed)
                for r in range(1, int(t[i].max(initial=0)) + 1):
                    who = np.flatnonzero(t[i] >= r)
                    for flip in combinations(range(len(g)), r):
                        places.append(v[who] ^ sum(1 << f for f in flip) | i << 40)
                        fps.append(signed[who])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(places)), pa.array(np.concatenate(fps))], names=["place", "fp"])
    return run


def _forest(x: np.ndarray, distance: int) -> np.ndarray:
    """For every value the smallest position in its component."""
    close = np.bitwise_count(x[:, None] ^ x[None, :]) <= distance
    label = np.arange(len(x))
    while True:
        new = np.where(close, label[None, :], len(x)).min(axis=1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _verify(distance):
    def run(batches):
        for b in batches:
            col = b.column("fps")
            flat = col.flatten().to_numpy().view(np.uint64)
            lens = np.asarray(col.value_lengths())
            at = np.concatenate([[0], np.cumsum(lens)])
            two = at[:-1][lens == 2]
            a, c = flat[two], flat[two + 1]
            ok = np.bitwise_count(a ^ c) <= distance
            us, vs = [a[ok]], [c[ok]]
            for i in np.flatnonzero(lens > 2):
                x = flat[at[i]:at[i + 1]]
                root = _forest(x, distance)
                tied = np.flatnonzero(root != np.arange(len(x)))
                us.append(x[tied])
                vs.append(x[root[tied]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(us).view(np.int64)), pa.array(np.concatenate(vs).view(np.int64))],
                names=["u", "v"])
    return run


def links(fps: DataFrame, distance: int = 2, parts: int = 3) -> DataFrame:
    """``u long, v long``: links between the distinct values of ``fp`` that
    connect exactly those which lie within ``distance`` bits, directly or
    through others."""
    if distance % 2:
        # An odd distance 2r + 1: one side flips one bit more.
        raise ValueError("distance must be even")
    groups = partition_bits(correlations(fps), parts)
    costs = [_costs(c, len(g), distance) for c, g in zip(_lead_counts(fps, groups), groups)]
    met = fps.select("fp").mapInArrow(_meetings(groups, costs, distance), "place long, fp long")
    size = materialize(met.groupBy("place").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "places")
    shared = met.join(size, "place")
    few = shared.where(F.col("n") <= MEET).groupBy("place").agg(F.collect_set("fp").alias("fps")) \
        .where(F.size("fps") > 1).select("fps").mapInArrow(_verify(distance), "u long, v long")
    # Crowded places: values within distance/2 flipped bits are the places.
    flips = [sum(1 << f for f in c) for r in range(distance // 2 + 1) for c in combinations(range(BITS), r)]
    flips = [f - (1 << BITS) if f >> 63 else f for f in flips]
    crowd = shared.where(F.col("n") > MEET).select("fp").distinct()
    around = crowd.select("fp", F.explode(F.array(*[F.lit(f) for f in flips])).alias("f")) \
        .select("fp", F.col("fp").bitwiseXOR(F.col("f")).alias("place"))
    many = around.groupBy("place").agg(F.min("fp").alias("v"), F.collect_set("fp").alias("fps")) \
        .where(F.size("fps") > 1).select(F.explode("fps").alias("u"), "v").where("u <> v")
    return few.unionByName(many).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, parts: int = 3,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, fp long, component_id long, text_hash long``, one row
    per row: the smallest document that is reached over links of at most
    ``distance`` bits (an even number, else an error), itself included.  Rows
    that share an id stand in the component of their own text.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case.  A null text is
    empty and has fingerprint zero; a text of fewer words than a shingle is
    one shingle; rows without an id are left out; other columns are not read."""
    fps = materialize(simhash(docs, shingle, id_col, text_col), "simhash")
    reps = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-distinct")
    roots = components(links(reps, distance, parts))
    of = reps.join(roots, reps["fp"] == roots["node"], "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    least = of.groupBy("root").agg(F.min("rep").alias("component_id"))
    # Written, so that the join by fingerprint has two plain exchanges and a
    # fingerprint with very many documents can be split.
    classes = materialize(of.join(least, "root").select("fp", "component_id"), "simhash-classes")
    return fps.join(classes, "fp").select("doc_id", "fp", "component_id", "text_hash")
