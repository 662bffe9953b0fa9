"""Substring deduplication with a count-min prefilter.

A window is ``n`` consecutive words of a document.  A word goes if it lies in
a window whose words also start in a document with a smaller id.

1. *Partition sketches.*  Every task hashes its windows and sends, for each
   hash segment, the sketch cells that it touched (32 bits from which the
   rows of the segment's sketch take their cell) and how often, saturated
   at two documents.  A window that several documents of one task share is
   sent once for the task; that it repeats in the others is known, and goes by
   a hash of the document, so that a line on very many documents does not
   gather in the segment of its windows.
2. *Merge.*  Each segment adds the partition sketches into one count-min
   sketch and answers every document with the cells whose estimate is two
   documents or more.  A sketch never underestimates, so no repeated window
   is lost.
3. *Exact pass.*  Only windows estimated repeated are grouped by 96 bits of
   their words; the smallest document of each group keeps its words.

Nothing is broadcast or collected.  A segment holds about ``SEGMENT_CHARS``
characters' worth of windows at every corpus size; the documents' text is
shuffled once (both joins read the same exchange).
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplekit.llm import common as C

SEGMENT_CHARS = 1 << 24   # characters of text whose windows meet in one segment
FLUSH = 1_200_000         # windows that a task packs together
EXACT_SHARE = 4           # segments of the first pass that share one of the second
DEPTH = 2                 # rows of the count-min sketch
CELLS_PER_WINDOW = 4      # width of a row, in cells per window of the segment

_EXACT = ("seg int, k1 binary, k2 binary, pos binary, docs binary, lens binary, "
          "kpos binary, kdocs binary, klens binary")
_SEEDS = (0x51ED270B, 0x7F4A7C15A2B3)


def _windows(buf, offs, n, seeds):
    """Hashes of the windows of a slice, with document number, first word in
    the document and words per document."""
    starts, ends, doc = C.word_spans(buf, offs)
    per_doc = np.bincount(doc, minlength=len(offs) - 1) if len(doc) else np.zeros(len(offs) - 1, np.int64)
    first = np.concatenate([[0], np.cumsum(per_doc)])
    m = len(doc) - n + 1
    if m <= 0:
        z = np.zeros(0, np.int64)
        return [np.zeros(0, np.uint64) for _ in seeds], z, z, per_doc
    ok = np.flatnonzero(doc[:m] == doc[n - 1:])
    hs = [C.window_hashes(C.word_hashes(buf, starts, ends, s), n, s)[ok] for s in seeds]
    return hs, doc[ok], ok - first[doc[ok]], per_doc


def _by_segment(seg, n_seg, arrays, docs):
    """Per segment: the arrays and the document runs, packed."""
    order, at = C.segment_order(seg, n_seg)
    arrays, docs = [a[order] for a in arrays], docs[order]
    for s in np.flatnonzero(np.diff(at)):
        lo, hi = at[s], at[s + 1]
        ids, lens = C.runs(docs[lo:hi])
        yield int(s), [a[lo:hi].tobytes() for a in arrays], ids.tobytes(), lens.tobytes()


def _emit(known, sent, n_sent, n_known, schema):
    """Rows of a flush: per segment what is sent and what is known already."""
    empty = b""
    rows = {s: [s, *arr, d, ln, *[empty] * (n_known + 2)] for s, arr, d, ln in sent}
    for s, arr, d, ln in known:
        row = rows.setdefault(s, [s, *[empty] * (n_sent + 2), *[empty] * (n_known + 2)])
        row[n_sent + 3:] = [*arr, d, ln]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows.values()), schema.types)], schema=schema)


_S_ARROW = pa.schema([("seg", pa.int32()), ("cells", pa.binary()), ("many", pa.binary()),
                      ("docs", pa.binary()), ("lens", pa.binary()), ("kcells", pa.binary()),
                      ("kdocs", pa.binary()), ("klens", pa.binary())])
_E_ARROW = pa.schema([("seg", pa.int32()), ("k1", pa.binary()), ("k2", pa.binary()),
                      ("pos", pa.binary()), ("docs", pa.binary()), ("lens", pa.binary()),
                      ("kpos", pa.binary()), ("kdocs", pa.binary()), ("klens", pa.binary())])


def _segment_of(h, n_seg):
    return (h >> np.uint64(32)) % np.uint64(n_seg)


def _cell_of(h):
    return (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _partition_sketches(n, n_seg):
    def flush(keys, docs):
        # One entry per key and document, then one per key; the others of a
        # key that several documents share are known to be repeated.
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        new_key = np.concatenate([[True], keys[1:] != keys[:-1]])
        new_doc = new_key | np.concatenate([[True], docs[1:] != docs[:-1]])
        keys, docs, new_key = keys[new_doc], docs[new_doc], new_key[new_doc]
        group = np.cumsum(new_key) - 1
        many = (np.bincount(group) > 1)[group]
        seg, cells = _segment_of(keys, n_seg), _cell_of(keys)
        rep, rest = np.flatnonzero(new_key), np.flatnonzero(~new_key)
        rep, rest = rep[np.argsort(docs[rep], kind="stable")], rest[np.argsort(docs[rest], kind="stable")]
        yield from _emit(
            _by_segment(C.segment_of_document(docs[rest], n_seg), n_seg, [cells[rest]], docs[rest]),
            _by_segment(seg[rep], n_seg, [cells[rep], many[rep].astype(np.uint8)], docs[rep]),
            2, 1, _S_ARROW)

    def run(batches):
        keys, docs, held = [], [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, hi, buf, offs in C.slices(batch):
                (h,), doc, _, _ = _windows(buf, offs, n, _SEEDS[:1])
                keys.append(h)
                docs.append(ids[lo:hi][doc])
                held += len(h)
                if held >= FLUSH:
                    yield from flush(np.concatenate(keys), np.concatenate(docs))
                    keys, docs, held = [], [], 0
        if held:
            yield from flush(np.concatenate(keys), np.concatenate(docs))
    return run


def _merge_sketches(table: pa.Table) -> pa.Table:
    cells = C.joined(table, "cells", np.uint32)
    weight = C.joined(table, "many", np.uint8).astype(np.int64) + 1
    docs = np.repeat(C.joined(table, "docs", np.int64), C.joined(table, "lens", np.int32))
    bits = max(4, int(np.ceil(np.log2(max(1, len(cells) * CELLS_PER_WINDOW)))))
    estimate = None
    for mult in C.multipliers(DEPTH, 17).astype(np.uint32) | np.uint32(1):
        cell = (cells * mult) >> np.uint32(32 - bits)
        row = np.bincount(cell, weights=weight, minlength=1 << bits)[cell]
        estimate = row if estimate is None else np.minimum(estimate, row)
    hit = np.flatnonzero(estimate >= 2) if len(cells) else np.zeros(0, np.int64)
    return C.per_document(
        np.concatenate([docs[hit], np.repeat(C.joined(table, "kdocs", np.int64),
                                             C.joined(table, "klens", np.int32))]),
        np.concatenate([cells[hit], C.joined(table, "kcells", np.uint32)]), "cells")


def _candidates(n, n_seg):
    def flush(k1, k2, pos, docs):
        # The smallest document of a key in this task asks for all; a larger
        # one already knows a smaller document with the same words.
        order = np.lexsort((pos, docs, k2, k1))
        k1, k2, pos, docs = k1[order], k2[order], pos[order], docs[order]
        new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
        least = docs[np.flatnonzero(new)][np.cumsum(new) - 1]
        ask, known = np.flatnonzero(docs == least), np.flatnonzero(docs != least)
        ask, known = ask[np.argsort(docs[ask], kind="stable")], known[np.argsort(docs[known], kind="stable")]
        seg = _segment_of(k1, n_seg)
        yield from _emit(
            _by_segment(C.segment_of_document(docs[known], n_seg), n_seg, [pos[known]], docs[known]),
            _by_segment(seg[ask], n_seg, [k1[ask], k2[ask], pos[ask]], docs[ask]),
            3, 1, _E_ARROW)

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, hi, buf, offs in C.slices(batch):
                (h1, h2), doc, pos, _ = _windows(buf, offs, n, _SEEDS)
                keys, of = [], []
                for i, packed in enumerate(batch.column("cells").slice(lo, hi - lo).to_pylist()):
                    for p in packed or ():
                        a = np.frombuffer(p, np.uint32).astype(np.uint64)
                        keys.append(a | np.uint64(i) << np.uint64(32))
                if not keys:
                    continue
                mine = doc.astype(np.uint64) << np.uint64(32) | _cell_of(h1).astype(np.uint64)
                hit = np.flatnonzero(np.isin(mine, np.concatenate(keys)))
                parts.append((h1[hit], _cell_of(h2[hit]), pos[hit].astype(np.uint32), ids[lo:hi][doc[hit]]))
                held += len(hit)
                if held >= FLUSH:
                    yield from flush(*map(np.concatenate, zip(*parts)))
                    parts, held = [], 0
        if held:
            yield from flush(*map(np.concatenate, zip(*parts)))
    return run


def _exact_groups(table: pa.Table) -> pa.Table:
    k1, k2 = C.joined(table, "k1", np.uint64), C.joined(table, "k2", np.uint32)
    pos = C.joined(table, "pos", np.uint32)
    docs = np.repeat(C.joined(table, "docs", np.int64), C.joined(table, "lens", np.int32))
    order = np.lexsort((docs, k2, k1))
    k1, k2, pos, docs = k1[order], k2[order], pos[order], docs[order]
    if len(k1):
        new = np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])])
        gone = np.flatnonzero(docs != docs[np.flatnonzero(new)][np.cumsum(new) - 1])
    else:
        gone = np.zeros(0, np.int64)
    return C.per_document(
        np.concatenate([docs[gone], np.repeat(C.joined(table, "kdocs", np.int64),
                                              C.joined(table, "klens", np.int32))]),
        np.concatenate([pos[gone], C.joined(table, "kpos", np.uint32)]), "pos")


def _cut(n):
    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, packed in zip(batch.column("text").cast(pa.large_binary()).to_pylist(),
                                    batch.column("pos").to_pylist()):
                words = text.split()
                gone = 0
                if packed:
                    step = np.zeros(len(words) + 1, np.int64)
                    at = np.unique(np.concatenate([np.frombuffer(p, np.uint32) for p in packed])).astype(np.int64)
                    step[at] += 1
                    np.subtract.at(step, at + n, 1)
                    keep = np.cumsum(step[:-1]) == 0
                    gone = len(words) - int(keep.sum())
                    n_words.append(len(words))
                    words = compress(words, keep.tolist())
                else:
                    n_words.append(len(words))
                n_removed.append(gone)
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_text"])
    return run


def substring_dedup(docs: DataFrame, n: int = 13, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` for every row with an id.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.  A null text is empty; texts
    of fewer than ``n`` words lose nothing; rows without an id are left out;
    rows with one id count as one document; other columns are not read."""
    d = C.id_and_text(docs, id_col, text_col)
    n_seg = C.segments_for(d, SEGMENT_CHARS, 16)
    sketch = d.mapInArrow(_partition_sketches(n, n_seg),
                          "seg int, cells binary, many binary, docs binary, lens binary, "
                          "kcells binary, kdocs binary, klens binary")
    repeated = (sketch.groupBy("seg").applyInArrow(_merge_sketches, "doc_id long, cells binary")
                .groupBy("doc_id").agg(F.collect_list("cells").alias("cells")))
    asked = d.join(repeated, "doc_id").select("doc_id", "text", "cells") \
        .mapInArrow(_candidates(n, max(16, n_seg // EXACT_SHARE)), _EXACT)
    gone = (asked.groupBy("seg").applyInArrow(_exact_groups, "doc_id long, pos binary")
            .groupBy("doc_id").agg(F.collect_list("pos").alias("pos")))
    return d.join(gone, "doc_id", "left").select("doc_id", "text", "pos") \
        .mapInArrow(_cut(n), "doc_id long, n_words long, n_removed long, kept_text string")
