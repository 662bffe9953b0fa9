"""Divergence audit of a corpus' sources: how far the word distributions of
the sources of a language lie apart, and which terms set a source off.

1. *Count.*  Tasks count terms per (language, source) and in how many rows a
   term stands, and send what they have counted; Spark adds up.  A language
   keeps the terms that stand in at least ``min_docs`` of its rows.
2. *Bitmaps.*  Kept terms are dealt into blocks by a hash.  Inside a block
   terms are numbered by falling frequency, and for every (group, count) the
   set of the terms that the group has just so often is stored as a bitset;
   words of 64 terms without a bit are left out.
3. *Cells.*  For a pair of groups, AND and popcount of two bitsets give how
   many terms the one has ``a`` times and the other ``b`` times.  Cells with a
   zero follow by complement from the sizes of the bitsets.  Every cell is
   multiplied by the divergence of its two shares; blocks add up.

A block holds about ``BLOCK_ENTRIES`` (source, term) entries at every corpus
size, so neither a frequent term nor a large source gathers in a task.  The
pairs are those of the sources of one language, which is the result's size.
All arithmetic is exact.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ripplekit.llm import common as C
from ripplekit.plans.lineage import materialize

MIN_DOCS = 10
TOP_TERMS = 10
BLOCK_ENTRIES = 1 << 18   # (source, term) entries whose bitsets meet in one task
FLUSH = 300_000           # terms that a task counts before it sends them
CELLS = 1 << 20           # pairs of bitset words looked at together
SCALE = 10**9

_TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
_GAP = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                     ("n", pa.int64()), ("docs", pa.int64())])
_BITSETS = "lang string, block int, terms long, source string, n long, words binary, bits binary"
_PAIRS = "lang string, source string, item string, value long"


def _count_terms(batches):
    counts: dict[tuple[str, str], Counter] = {}
    docs: dict[tuple[str, str], Counter] = {}

    def flush():
        for (lang, source), n in counts.items():
            terms = list(n)
            d = docs[lang, source]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                 pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                 pa.array([d[t] for t in terms], pa.int64())], schema=_COUNTS)
        counts.clear()
        docs.clear()

    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        for group, text in zip(groups, batch.column("text").cast(pa.large_binary())):
            n = counts.setdefault(group, Counter())
            d = docs.setdefault(group, Counter())
            seen: set[bytes] = set()
            for part in C.parts(text.as_py().lower(), _GAP):   # bytes: A-Z only
                terms = _TERM.findall(part)
                n.update(terms)
                seen.update(terms)
            d.update(seen)
        if sum(map(len, counts.values())) > FLUSH:
            yield from flush()
    yield from flush()


def term_counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, kept_n``: occurrences of the kept terms in a
    group and in its language; written."""
    counted = docs.mapInArrow(_count_terms, "lang string, source string, term string, n long, docs long") \
        .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    kept = counted.withColumn("in_docs", F.sum("docs").over(of_term)) \
        .withColumn("kept_n", F.sum("n").over(of_term)).where(F.col("in_docs") >= min_docs)
    return materialize(kept.select("lang", "source", "term", "n", "kept_n"), "divergence-terms")


def group_totals(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """``lang, source, total, lang_total, kept``: every group with the
    occurrences of kept terms in it and in its language, and how many terms
    the language keeps."""
    groups = docs.select("lang", "source").distinct()
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = entries.groupBy("lang", "term").agg(F.sum("n").alias("n")) \
        .groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count(F.lit(1)).alias("kept"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return materialize(groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
                       .select("lang", "source", zero("total"), zero("lang_total"), zero("kept")),
                       "divergence-groups")


def _bitsets(table: pa.Table) -> pa.Table:
    """The (source, count) bitsets of a block."""
    lang, block = table.column("lang")[0], table.column("block")[0]
    terms = table.column("term").combine_chunks().dictionary_encode()
    sources = table.column("source").combine_chunks().dictionary_encode()
    n = table.column("n").to_numpy()
    code, source = terms.indices.to_numpy(), sources.indices.to_numpy().astype(np.int64)
    total = np.zeros(len(terms.dictionary), np.int64)
    total[code] = table.column("kept_n").to_numpy()
    number = np.empty(len(total), np.int64)
    number[np.argsort(-total, kind="stable")] = np.arange(len(total))
    at = number[code]
    word, bit = at >> 6, np.uint64(1) << (at & 63).astype(np.uint64)
    order = np.lexsort((word, n, source))
    source, n, word, bit = source[order], n[order], word[order], bit[order]
    new_set = np.concatenate([[True], (source[1:] != source[:-1]) | (n[1:] != n[:-1])])
    new_word = new_set | np.concatenate([[True], word[1:] != word[:-1]])
    first = np.flatnonzero(new_word)
    bits = np.bitwise_or.reduceat(bit, first)
    sets = np.flatnonzero(new_set)
    lengths = np.diff(np.append(np.flatnonzero(new_set[first]), len(first)))
    k = len(sets)
    return pa.table({
        "lang": pa.array([lang.as_py()] * k, pa.string()), "block": pa.array([block.as_py()] * k, pa.int32()),
        "terms": pa.array([len(total)] * k, pa.int64()),
        "source": sources.dictionary.take(pa.array(source[sets])).cast(pa.string()),
        "n": pa.array(n[sets], pa.int64()),
        "words": C.binary_rows(word[first].astype(np.uint32), lengths), "bits": C.binary_rows(bits, lengths)})


def count_bitmaps(entries: DataFrame, n_blocks: int) -> DataFrame:
    """The stored bitmaps, one row per (language, block, source, count):
    numbers of the 64-term words that have a bit, and the words."""
    dealt = entries.withColumn("block", F.pmod(F.xxhash64("term"), F.lit(n_blocks)).cast("int"))
    return materialize(dealt.groupBy("lang", "block").applyInArrow(_bitsets, _BITSETS), "divergence-bitmaps")


def share(n: np.ndarray, total: int, kept: int) -> np.ndarray:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), by long division."""
    whole, rest = np.zeros(len(n), np.int64), n.astype(np.int64) + 2
    for _ in range(3):
        rest = rest * 1000
        whole, rest = whole * 1000 + rest // (total + 2 * kept), rest % (total + 2 * kept)
    return 1 + whole


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class _Group:
    """A source's bitsets of a block: per word with a bit its number, bits and
    count level, by word; levels have a share and a number of terms."""

    def __init__(self, n, words, bits, total, kept):
        self.shares = share(np.append(n, 0), total, kept)   # the last: of a count of zero
        level = np.repeat(np.arange(len(n)), [len(w) // 4 for w in words])
        word = np.frombuffer(b"".join(words), np.uint32).astype(np.int64)
        bits = np.frombuffer(b"".join(bits), np.uint64)
        order = np.argsort(word, kind="stable")
        self.word, self.level, self.bits = word[order], level[order], bits[order]
        self.sizes = np.bincount(self.level, weights=np.bitwise_count(self.bits),
                                 minlength=len(n)).astype(np.int64)


def _value(g: _Group, h: _Group, terms: int) -> int:
    """Divergence of two groups over the terms of a block."""
    p, q = g.shares[:-1], h.shares[:-1]
    p0, q0 = g.shares[-1:], h.shares[-1:]
    in_g, in_h = g.sizes.copy(), h.sizes.copy()   # terms that the other group lacks, after the cells
    lo, hi = np.searchsorted(h.word, g.word, "left"), np.searchsorted(h.word, g.word, "right")
    ends = np.cumsum(hi - lo)
    value, both, a = 0, 0, 0
    while a < len(ends):
        done = int(ends[a - 1]) if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + CELLS, "right")))
        times = (hi - lo)[a:b]
        of_g = np.repeat(np.arange(a, b), times)
        of_h = np.arange(len(of_g)) + np.repeat(lo[a:b] - (ends[a:b] - times - done), times)
        n = np.bitwise_count(g.bits[of_g] & h.bits[of_h]).astype(np.int64)
        hit = np.flatnonzero(n)
        n, i, j = n[hit], g.level[of_g[hit]], h.level[of_h[hit]]
        value += int((n * divergence(p[i], q[j])).sum())
        both += int(n.sum())
        np.subtract.at(in_g, i, n)
        np.subtract.at(in_h, j, n)
        a = b
    value += int((in_g * divergence(p, q0)).sum()) + int((in_h * divergence(p0, q)).sum())
    neither = terms - int(g.sizes.sum()) - int(h.sizes.sum()) + both
    return value + neither * int(divergence(p0, q0)[0])


def _cells(key, sets: pa.Table, groups: pa.Table) -> pa.Table:
    lang, block = (k.as_py() for k in key)
    out = []
    if block == 0 or sets.num_rows:
        terms = sets.column("terms")[0].as_py() if sets.num_rows else 0
        rows: dict[str, list] = {}
        for r in sets.select(["source", "n", "words", "bits"]).to_pylist():
            rows.setdefault(r["source"], []).append((r["n"], r["words"], r["bits"]))
        held = []
        for r in groups.to_pylist():
            n, words, bits = zip(*rows[r["source"]]) if r["source"] in rows else ((), (), ())
            held.append((r["source"], terms and _Group(np.array(n, np.int64), words, bits, r["total"], r["kept"])))
        for i, (a, g) in enumerate(held):
            for b, h in held[i + 1:]:
                v = _value(g, h, terms) if terms else 0
                out += [(lang, a, b, v), (lang, b, a, v)]
    return pa.table([pa.array(c, t) for c, t in zip(
        zip(*out) if out else [[]] * 4, (pa.string(), pa.string(), pa.string(), pa.int64()))],
        names=["lang", "source", "item", "value"])


def _share(n: str, total: str) -> Column:
    return F.expr(f"1 + cast({SCALE} as decimal(10,0)) * cast({n} + 2 as decimal(19,0)) "
                  f"div cast({total} + 2 * kept as decimal(20,0))")


def distinctive_terms(entries: DataFrame, totals: DataFrame, top: int) -> DataFrame:
    """``lang, source, item, value``, the terms of a group that are more
    frequent in it than in its language, the ``top`` of the highest
    divergence."""
    t = entries.join(totals, ["lang", "source"]) \
        .withColumn("_p", _share("n", "total")).withColumn("_q", _share("kept_n", "lang_total")) \
        .where("_p > _q")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return t.select("lang", "source", F.col("term").alias("item"),
                    F.expr("(_p - _q) * (_p - _q) div (_p + _q)").alias("value")) \
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS,
          block_entries: int = BLOCK_ENTRIES) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    Part ``pair``: per group every other source of its language, part
    ``term``: the group's ``top`` distinctive terms; ranks by falling value,
    equal ones by item.  A null text, language or source counts as ``''``;
    every row is a document, also one that repeats or has no id; a group
    without terms has its pairs; a language that keeps no term has pairs of
    value 0 and no terms; an empty table gives an empty result.  Other columns
    are not read."""
    C.bounded_batches(docs.sparkSession)
    d = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    entries = term_counts(d, min_docs)
    totals = group_totals(d, entries)
    n_blocks = max(1, -(-entries.count() // block_entries))
    bitmaps = count_bitmaps(entries, n_blocks)
    everywhere = totals.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    pairs = bitmaps.groupBy("lang", "block").cogroup(everywhere.groupBy("lang", "block")) \
        .applyInArrow(_cells, _PAIRS).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order))
    cols = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.withColumn("part", F.lit("pair")).select(*cols).unionByName(
        distinctive_terms(entries, totals, top).withColumn("part", F.lit("term")).select(*cols))
