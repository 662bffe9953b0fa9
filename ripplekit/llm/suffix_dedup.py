"""Suffix-array deduplication: bytes of strings of ``length`` that also start
elsewhere are removed.

Column-wise construction (``bwt.py``) inserts one symbol per string and
round, so its strings must be short and its collections bounded.  Both are
arranged without losing a repeat:

1. *Anchors.*  Every window of ``length`` bytes has an anchor, its least
   hashed ``GRAM``-gram (the leftmost, on ties), so equal windows have equal
   anchors at equal offsets.  Consecutive windows with one anchor and an
   offset in one class of ``CLASS`` offsets make an *entry*: a string of less
   than ``length + CLASS`` bytes.  All windows of an entry share a core of
   ``length - CLASS + 1`` bytes around the anchor; its hash is the entry's key.
   Every window lies in one entry, and equal windows in entries of one key.
2. *Keys.*  A first pass counts the different strings of every key and finds
   the frequent keys, at most 2^20 at any corpus size; see 3.  Then tasks
   send packed keys, string hashes and places by hash segment.
   An entry whose key occurs once holds no repeat.  Of equal strings under a
   key one is kept: their windows are repeats all.
3. *Suffix arrays.*  Different strings under one key are cut from the texts
   and meet in a collection (whole keys, about ``COLLECTION`` symbols),
   with one symbol in place of the core, which all their windows contain; its Burrows-Wheeler transform and common prefixes
   tell which windows repeat.  Where more than ``CROWD`` different
   strings share a key, and for frequent keys, each window is grouped by a
   96-bit hash instead, of equal ones once per task, so that neither a
   collection nor a segment grows with a frequent passage.
4. *Cut.*  Every document learns its repeated windows and drops their bytes.

Only the frequent keys (eight bytes each) are collected, and the texts are shuffled once (all joins
read the same exchange).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.llm import common as C
from ripplekit.llm.bwt import repeated_starts

LENGTH = 400
GRAM = 100
CLASS = 50
CROWD = 4096
FREQUENT_BITS = 20
SEGMENT_CHARS = 1 << 24   # characters of text whose entries meet in one segment
FLUSH = 400_000
SLICE = 1 << 19
PLACE_BITS = np.uint64(32)   # of a place in a slice; a document is shorter than 4 GB
COLLECTION = 1 << 20         # symbols of a collection, next to those of its last key
WINDOWS = 400_000            # that are hashed together

KNOWN, SEND, SPREAD = 1, 2, 3
_ASK = np.dtype([("key", "<u8"), ("start", "<u4"), ("len", "<u2"), ("left", "u1"), ("what", "u1"), ("many", "u1")])
_SPAN = np.dtype([("start", "<u4"), ("len", "<u4")])
_ENTRY_COLS = ("key", "sh", "start", "len", "left", "many", "docs", "lens", "kspans", "kdocs", "klens")
_ENTRY = "seg int, " + ", ".join(f"{c} binary" for c in _ENTRY_COLS)
_STRING_COLS = ("data", "len", "left", "key", "core", "start", "many", "docs", "lens")
_WINDOW_COLS = ("key", "key2", "start", "many", "docs", "lens", "kspans", "kdocs", "klens")
_WINDOW = "seg int, " + ", ".join(f"{c} binary" for c in _WINDOW_COLS)
_STRING = "seg int, " + ", ".join(f"{c} binary" for c in _STRING_COLS)


class _Rolling:
    """Hashes of any byte range of a buffer (sums of random byte values times
    powers of an odd base, modulo 2^64)."""

    base = 0x9E3779B97F4A7C15 | 1
    _powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __init__(self, buf: np.ndarray, n: int, seed: int = 0):
        up, down = self._tables(n + 1)
        self.down = down
        values = C.mix(np.arange(1, 257, dtype=np.uint64) * C._GOLD + np.uint64(seed))
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(values[buf[:n]] * up[:n], dtype=np.uint64)])

    @classmethod
    def _tables(cls, n):
        if len(cls._powers[0]) < n:
            both = []
            for b in (cls.base, pow(cls.base, -1, 1 << 64)):
                p = np.full(n, b, np.uint64)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
            if n > 4 * SLICE:      # of one very long document: not kept
                return both
            cls._powers = tuple(both)
        return cls._powers[0][:n], cls._powers[1][:n]

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return C.mix((self.sums[hi] - self.sums[lo]) * self.down[lo] + (hi - lo).astype(np.uint64))


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i + w]) for every i with a whole window."""
    n = len(x)
    rows = -(-n // w)
    pad = np.full(rows * w, np.iinfo(np.uint64).max, np.uint64)
    pad[:n] = x
    grid = pad.reshape(rows, w)
    head = np.minimum.accumulate(grid, axis=1).ravel()
    tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(tail[:n - w + 1], head[w - 1:n])


def _entries_of(buf, offs, length, gram, klass):
    """Entries of a slice: first and last window, bytes before the core,
    document, key, string hash."""
    n = int(offs[-1])
    z = np.zeros(0, np.int64)
    if n < length:
        return z, z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    roll = _Rolling(buf, n)
    at = np.arange(n - gram + 1)
    # The same hash bits in every slice, so that equal windows agree; the
    # others hold the place.
    g = roll(at, at + gram) >> PLACE_BITS << PLACE_BITS | at.astype(np.uint64)
    g = _sliding_min(g, length - gram + 1)          # one per window start
    anchor = (g & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    # windows inside a document
    inside = np.zeros(n + 1, np.int32)
    lo, hi = offs[:-1], np.maximum(offs[:-1], offs[1:] - length + 1)
    np.add.at(inside, lo, 1)
    np.add.at(inside, hi, -1)
    s = np.flatnonzero(np.cumsum(inside)[:len(anchor)] > 0)
    if not len(s):
        return z, z, z, z, z.astype(np.uint64), z.astype(np.uint64)
    a = anchor[s]
    k = (a - s) // klass
    doc = np.searchsorted(offs, s, "right") - 1
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (k[1:] != k[:-1]) | (doc[1:] != doc[:-1])]))
    first, last = s[new], s[np.append(new[1:], len(s)) - 1]
    a, k, doc = a[new], k[new], doc[new]
    core = a - k * klass
    key = C.mix(roll(core, core + length - klass + 1) ^ k.astype(np.uint64))
    return first, last, core - first, doc, key, roll(first, last + length)


def _by_seg(seg, n_seg, arrays, docs):
    order, at = C.segment_order(seg, n_seg)
    arrays, docs = [a[order] for a in arrays], docs[order]
    for s in np.flatnonzero(np.diff(at)):
        lo, hi = at[s], at[s + 1]
        ids, lens = C.runs(docs[lo:hi])
        yield int(s), [*(a[lo:hi].tobytes() for a in arrays), ids.tobytes(), lens.tobytes()]


def _rows(parts, widths, names):
    """Record batch of one row per segment from several lists of columns."""
    rows: dict[int, list] = {}
    skip = 0
    for part, width in zip(parts, widths):
        for s, cols in part:
            rows.setdefault(s, [b""] * sum(widths))[skip:skip + width] = cols
        skip += width
    segs = sorted(rows)
    yield pa.RecordBatch.from_arrays(
        [pa.array(segs, pa.int32()), *(pa.array([rows[s][i] for s in segs], pa.binary()) for i in range(sum(widths)))],
        names=["seg", *names])


def _first_of_groups(*keys):
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


def _entries(n_seg, length, gram, klass, frequent):
    def flush(held):
        key, sh, start, size, left, docs = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((start, docs, sh, key))
        key, sh, start, size, left, docs = (x[order] for x in (key, sh, start, size, left, docs))
        new = _first_of_groups(key, sh)
        group = np.cumsum(new) - 1
        many = (np.bincount(group) > 1)[group].astype(np.uint8)
        rep, rest = np.flatnonzero(new), np.flatnonzero(~new)
        rep, rest = rep[np.argsort(docs[rep], kind="stable")], rest[np.argsort(docs[rest], kind="stable")]
        spans = np.zeros(len(rest), _SPAN)
        spans["start"], spans["len"] = start[rest], size[rest]
        seg = (key >> np.uint64(20)) % np.uint64(n_seg)
        yield from _rows(
            [_by_seg(seg[rep], n_seg, [key[rep], sh[rep], start[rep], size[rep], left[rep], many[rep]],
                     docs[rep]),
             _by_seg(C.segment_of_document(docs[rest], n_seg), n_seg, [spans], docs[rest])], [8, 3], _ENTRY_COLS)

    def run(batches):
        held, n = [], 0
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, hi, buf, offs in C.slices(b, most=SLICE):
                first, last, left, doc, key, sh = _entries_of(buf, offs, length, gram, klass)
                if len(frequent):
                    rare = ~np.isin(key, frequent)
                    first, last, left, doc, key, sh = (x[rare] for x in (first, last, left, doc, key, sh))
                held.append((key, sh, (first - offs[doc]).astype(np.uint32),
                             (last - first + length).astype(np.uint16), left.astype(np.uint8), ids[lo:hi][doc]))
                n += len(first)
                if n >= FLUSH:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)
    return run


def _key_counts(n_seg, length, gram, klass):
    """Distinct strings per key in some slices, by segment."""
    def flush(held):
        key, sh = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((sh, key))
        key, sh = key[order], sh[order]
        key, n = np.unique(key[_first_of_groups(key, sh)], return_counts=True)
        order, at = C.segment_order((key >> np.uint64(20)) % np.uint64(n_seg), n_seg)
        key, n = key[order], n[order].astype(np.uint32)
        used = np.flatnonzero(np.diff(at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), *(pa.array([x[at[s]:at[s + 1]].tobytes() for s in used], pa.binary())
                                           for x in (key, n))], names=["seg", "key", "n"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            for _, _, buf, offs in C.slices(b, most=SLICE):
                held.append(_entries_of(buf, offs, length, gram, klass)[4:])
                n += len(held[-1][0])
                if n >= FLUSH:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)
    return run


def _frequent(least):
    def run(table: pa.Table) -> pa.Table:
        key, at = np.unique(C.joined(table, "key", np.uint64), return_inverse=True)
        n = np.bincount(at, weights=C.joined(table, "n", np.uint32))
        return pa.table({"key": pa.array(key[n > least].view(np.int64))})
    return run


def _docs(table, docs="docs", lens="lens"):
    return np.repeat(C.joined(table, docs, np.int64), C.joined(table, lens, np.int32))


def _shared_keys(crowd):
    def run(table: pa.Table) -> pa.Table:
        key, sh = C.joined(table, "key", np.uint64), C.joined(table, "sh", np.uint64)
        start, size = C.joined(table, "start", np.uint32), C.joined(table, "len", np.uint16)
        left, many, docs = C.joined(table, "left", np.uint8), C.joined(table, "many", np.uint8), _docs(table)
        order = np.lexsort((start, docs, sh, key))
        key, sh, start, size, left, many, docs = (x[order] for x in (key, sh, start, size, left, many, docs))
        if not len(key):
            return pa.table({"doc_id": pa.array([], pa.int64()), "asks": pa.array([], pa.binary())})
        new_key, new_str = _first_of_groups(key), _first_of_groups(key, sh)
        of_key, of_str = np.cumsum(new_key) - 1, np.cumsum(new_str) - 1
        total = np.bincount(of_str)
        again = ((total > 1) | (np.bincount(of_str, weights=many) > 0))[of_str]
        strings = np.bincount(of_key, weights=new_str).astype(np.int64)[of_key]
        ask = np.zeros(len(key), _ASK)
        ask["key"], ask["start"], ask["len"], ask["left"], ask["many"] = key, start, size, left, again
        ask["what"] = np.where(new_str & (strings > 1), np.where(strings > crowd, SPREAD, SEND),
                               np.where(again, KNOWN, 0))
        hit = ask["what"] > 0
        spans = np.frombuffer(C.joined(table, "kspans", np.uint8).tobytes(), _SPAN)
        known = np.zeros(len(spans), _ASK)
        known["start"], known["len"], known["what"], known["many"] = spans["start"], spans["len"], KNOWN, 1
        return C.per_document(np.concatenate([docs[hit], _docs(table, "kdocs", "klens")]),
                              np.concatenate([ask[hit], known]), "asks")
    return run


def _strings(n_seg, what, core):
    """The strings asked for, by the segment of their key, without the
    ``core`` bytes that those of a key share (0: whole), and its hash."""
    def run(batches):
        for b in batches:
            texts = b.column("text").cast(pa.large_binary())
            pieces, asks, docs, cores = [], [], [], []
            for doc, text, packed in zip(b.column("doc_id").to_pylist(), texts, b.column("asks").to_pylist()):
                ask = np.frombuffer(b"".join(packed), _ASK)
                ask = ask[ask["what"] == what]
                if len(ask):
                    t = text.as_buffer()
                    for s, n, left in zip(ask["start"].tolist(), ask["len"].tolist(), ask["left"].tolist()):
                        at = s + left
                        cores.append(xxhash.xxh64_intdigest(t[at:at + core], 7))
                        pieces.append(bytes(t[s:at]) + bytes(t[at + core:s + n]))
                    asks.append(ask)
                    docs.append(np.full(len(ask), doc))
            if not pieces:
                continue
            ask, docs, cores = np.concatenate(asks), np.concatenate(docs), np.array(cores, np.uint64)
            order, at = C.segment_order((ask["key"] >> np.uint64(20)) % np.uint64(n_seg), n_seg)
            rows = []
            for s in np.flatnonzero(np.diff(at)):
                i = order[at[s]:at[s + 1]]
                ids, lens = C.runs(docs[i])
                rows.append([int(s), b"".join(pieces[j] for j in i), ask["len"][i].tobytes(),
                             ask["left"][i].tobytes(), ask["key"][i].tobytes(), cores[i].tobytes(),
                             ask["start"][i].tobytes(), ask["many"][i].tobytes(), ids.tobytes(), lens.tobytes()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))],
                names=["seg", *_STRING_COLS])
    return run


def _suffix_arrays(length, core):
    """Repeated windows of the strings of a segment.  One symbol stands for
    the core of a key, which each of its windows contains: a window is then
    ``length - core + 1`` symbols long."""
    def run(table: pa.Table) -> pa.Table:
        size = C.joined(table, "len", np.uint16).astype(np.int64)
        left = C.joined(table, "left", np.uint8).astype(np.int64)
        start = C.joined(table, "start", np.uint32).astype(np.int64)
        many, docs = C.joined(table, "many", np.uint8) > 0, _docs(table)
        if not len(size):
            return pa.table({"doc_id": pa.array([], pa.int64()), "spans": pa.array([], pa.binary())})
        rest, at = C.joined(table, "data", np.uint8), np.concatenate([[0], np.cumsum(size - core)])
        both = np.stack([C.joined(table, "core", np.uint64), C.joined(table, "key", np.uint64)])
        order = np.lexsort(both)                    # by key, then core
        name = np.cumsum(_first_of_groups(both[1][order], both[0][order]))
        new_key = np.flatnonzero(_first_of_groups(both[1][order]))
        symbols = np.concatenate([[0], np.cumsum(size[order] - core + 1)])
        # whole keys; a collection begins less than COLLECTION symbols behind the one before
        cuts = np.append(new_key[_first_of_groups(symbols[new_key] // COLLECTION)], len(order)).tolist()
        out_docs, spans = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            mine = order[lo:hi]
            offs = symbols[lo:hi + 1] - symbols[lo]
            data = np.empty(offs[-1], np.int32)
            is_core = np.zeros(offs[-1], bool)
            is_core[offs[:-1] + left[mine]] = True
            data[~is_core] = np.concatenate([rest[at[i]:at[i + 1]] for i in mine])
            data[is_core] = 256 + name[lo:hi]
            for i, hits in zip(mine, repeated_starts(data, offs, length - core + 1)):
                hits = np.arange(size[i] - length + 1) if many[i] else hits
                if len(hits):
                    first = np.concatenate([[True], np.diff(hits) > 1])
                    a, z = hits[first], hits[np.append(first[1:], True)]
                    span = np.zeros(len(a), _SPAN)
                    span["start"], span["len"] = start[i] + a, z - a + length
                    spans.append(span)
                    out_docs.append(np.full(len(a), docs[i]))
        if not spans:
            return pa.table({"doc_id": pa.array([], pa.int64()), "spans": pa.array([], pa.binary())})
        return C.per_document(np.concatenate(out_docs), np.concatenate(spans), "spans")
    return run


def _window_rows(key, key2, at, many, docs, n_seg, length):
    """Windows by the segment of their hash: one of equal windows goes on, the
    others are known to repeat."""
    order = np.lexsort((key2, key))
    key, key2, at, docs = key[order], key2[order].astype(np.uint32), at[order].astype(np.uint32), docs[order]
    new = _first_of_groups(key, key2)
    group = np.cumsum(new) - 1
    again = ((np.bincount(group) > 1) | (np.bincount(group, weights=many[order]) > 0))[group].astype(np.uint8)
    rep, rest = np.flatnonzero(new), np.flatnonzero(~new)
    rep, rest = rep[np.argsort(docs[rep], kind="stable")], rest[np.argsort(docs[rest], kind="stable")]
    spans = np.zeros(len(rest), _SPAN)
    spans["start"], spans["len"] = at[rest], length
    seg = (key >> np.uint64(20)) % np.uint64(n_seg)
    yield from _rows([_by_seg(seg[rep], n_seg, [key[rep], key2[rep], at[rep], again[rep]], docs[rep]),
                      _by_seg(C.segment_of_document(docs[rest], n_seg), n_seg, [spans], docs[rest])],
                     [6, 3], _WINDOW_COLS)


def _single_windows(n_seg, length):
    """Every window of the strings of crowded keys, by its own hash."""
    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            data, docs, many = C.joined(t, "data", np.uint8), _docs(t), C.joined(t, "many", np.uint8) > 0
            start = C.joined(t, "start", np.uint32).astype(np.int64)
            offs = np.concatenate([[0], np.cumsum(C.joined(t, "len", np.uint16).astype(np.int64))])
            held, n = [], 0
            for i in range(len(docs)):
                s = data[offs[i]:offs[i + 1]]
                w = np.arange(len(s) - length + 1)
                held.append((_Rolling(s, len(s))(w, w + length), _Rolling(s, len(s), 99)(w, w + length),
                             start[i] + w, np.full(len(w), i)))
                n += len(w)
                if n >= WINDOWS or i + 1 == len(docs):
                    key, key2, at, of = map(np.concatenate, zip(*held))
                    yield from _window_rows(key, key2, at, many[of], docs[of], n_seg, length)
                    held, n = [], 0
    return run


def _frequent_windows(frequent, n_seg, length, gram, klass):
    """Every window of the entries of frequent keys, by its own hash."""
    def run(batches):
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, hi, buf, offs in C.slices(b, most=SLICE):
                first, last, _, doc, key, _ = _entries_of(buf, offs, length, gram, klass)
                hit = np.isin(key, frequent)
                n = (last - first + 1)[hit]
                if not len(n):
                    continue
                w = np.arange(n.sum()) + np.repeat(first[hit] - (np.cumsum(n) - n), n)
                of = np.repeat(doc[hit], n)
                size = int(offs[-1])
                yield from _window_rows(
                    _Rolling(buf, size)(w, w + length), _Rolling(buf, size, 99)(w, w + length),
                    w - offs[of], np.zeros(len(w), bool), ids[lo:hi][of], n_seg, length)
    return run


def _equal_windows(length):
    def run(table: pa.Table) -> pa.Table:
        key, key2 = C.joined(table, "key", np.uint64), C.joined(table, "key2", np.uint32)
        start, many, docs = C.joined(table, "start", np.uint32), C.joined(table, "many", np.uint8), _docs(table)
        order = np.lexsort((key2, key))
        new = _first_of_groups(key[order], key2[order])
        group = np.empty(len(key), np.int64)
        group[order] = np.cumsum(new) - 1
        hit = ((np.bincount(group) > 1) | (np.bincount(group, weights=many) > 0))[group]
        span = np.zeros(int(hit.sum()), _SPAN)
        span["start"], span["len"] = start[hit], length
        known = np.frombuffer(C.joined(table, "kspans", np.uint8).tobytes(), _SPAN)
        return C.per_document(np.concatenate([docs[hit], _docs(table, "kdocs", "klens")]),
                              np.concatenate([span, known]), "spans")
    return run


def _cut(batches):
    for b in batches:
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for text, asks, spans in zip(b.column("text").cast(pa.large_binary()).to_pylist(),
                                     b.column("asks").to_pylist(), b.column("spans").to_pylist()):
            parts = []
            if asks:
                ask = np.frombuffer(b"".join(asks), _ASK)
                ask = ask[ask["many"] > 0]
                parts.append((ask["start"].astype(np.int64), ask["len"].astype(np.int64)))
            if spans:
                span = np.frombuffer(b"".join(spans), _SPAN)
                parts.append((span["start"].astype(np.int64), span["len"].astype(np.int64)))
            n_bytes.append(len(text))
            lo = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
            if not len(lo):
                n_removed.append(0)
                n_spans.append(0)
                kept.append(text)
                continue
            size = np.concatenate([p[1] for p in parts])
            order = np.argsort(lo, kind="stable")
            lo, hi = lo[order], np.maximum.accumulate((lo + size)[order])
            first = np.concatenate([[True], lo[1:] > hi[:-1]])
            starts, ends = lo[first].tolist(), hi[np.append(first[1:], True)].tolist()
            n_removed.append(sum(ends) - sum(starts))
            n_spans.append(len(starts))
            kept.append(b"".join(text[a:z] for a, z in zip([0, *ends], [*starts, len(text)])))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n_bytes, n_removed, n_spans)),
             pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def suffix_dedup(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, klass: int = CLASS,
                 crowd: int = CROWD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept binary`` for every row with
    an id; ``kept`` are the bytes left of the UTF-8 text (a cut may lie
    inside a character).

    A null text is empty, and shorter texts than ``length`` lose nothing; a
    repeat inside one document counts; rows without an id are left out; ids
    must be unique, other columns are not read."""
    d = C.id_and_text(docs, id_col, text_col)
    chars = d.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n_seg = max(64, -(-chars // SEGMENT_CHARS))
    # A text has no more entries than characters: at most 2^FREQUENT_BITS keys
    # have more strings than this.
    least = max(crowd, chars >> FREQUENT_BITS)
    found = d.select("text").mapInArrow(_key_counts(n_seg, length, gram, klass), "seg int, key binary, n binary") \
        .groupBy("seg").applyInArrow(_frequent(least), "key long").collect()
    frequent = np.sort(np.array([r.key for r in found], np.int64).view(np.uint64))
    asks = (d.mapInArrow(_entries(n_seg, length, gram, klass, frequent), _ENTRY)
            .groupBy("seg").applyInArrow(_shared_keys(crowd), "doc_id long, asks binary")
            .groupBy("doc_id").agg(F.collect_list("asks").alias("asks")))
    asked = d.join(asks, "doc_id").select("doc_id", "text", "asks")
    core = length - klass + 1
    sent = asked.mapInArrow(_strings(n_seg, SEND, core), _STRING) \
        .groupBy("seg").applyInArrow(_suffix_arrays(length, core), "doc_id long, spans binary")
    spread = asked.mapInArrow(_strings(n_seg, SPREAD, 0), _STRING).mapInArrow(_single_windows(n_seg, length), _WINDOW)
    if len(frequent):
        spread = spread.unionByName(d.mapInArrow(_frequent_windows(frequent, n_seg, length, gram, klass), _WINDOW))
    single = spread.groupBy("seg").applyInArrow(_equal_windows(length), "doc_id long, spans binary")
    spans = sent.unionByName(single).groupBy("doc_id").agg(F.collect_list("spans").alias("spans"))
    return d.join(asks, "doc_id", "left").join(spans, "doc_id", "left").select("doc_id", "text", "asks", "spans") \
        .mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
