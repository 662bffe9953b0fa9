"""Helpers that the operators share: whole texts as byte arrays inside tasks,
word and window hashes, and rows that carry many values for one hash segment.

A *segment* is a range of hash values.  Instead of one Spark row per window,
a map task sends one row per segment with packed arrays, and Spark's shuffle
groups the rows of a segment.  The number of segments follows the size of the
corpus (:func:`segments_for`), so one segment always holds about as much.
"""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of text that a task looks at together; bounds its arrays.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_M1, _M2, _GOLD = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB,
                                          0x9E3779B97F4A7C15))


# Rows and bytes of a batch that goes to Python, at most.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers in small batches; a session that has
    smaller ones keeps them."""
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = re.fullmatch(r"(-?\d+)b?", spark.conf.get(key))
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(key, str(most))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id long, text string`` of the rows that have an id; a null text
    counts as empty."""
    bounded_batches(docs.sparkSession)
    return docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def text_hash(text_col: str = "text") -> Column:
    """64-bit hash of a text, null counted as empty: tells rows of one id with
    different texts apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def segments_for(docs: DataFrame, chars: int, least: int, text_col: str = "text") -> int:
    """How many hash segments hold about ``chars`` characters of text each;
    one count over the whole table."""
    total = docs.agg(F.sum(F.length(text_col)).alias("n")).first()["n"] or 0
    return max(least, -(-total // chars))


def spill_file():
    """A nameless file for what a task cannot hold, in the folder where Spark's
    own sorts spill; it goes when it is closed, and no other task can see it."""
    return tempfile.TemporaryFile(dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None)


def binary_parts(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary Arrow column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    a = col.cast(pa.large_binary())
    if a.null_count:
        a = a.fill_null(b"")
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(a.buffers()[1], np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] else np.zeros(0, np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def slices(batch: pa.RecordBatch, text_col: str = "text",
           most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of whole documents of at most ``most`` bytes (a
    longer document is a run of its own): ``(first row, end row, bytes with 8
    zero bytes behind, offsets)``."""
    data, offs = binary_parts(batch.column(text_col))
    lo, n = 0, batch.num_rows
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + most, "right")) - 1)
        buf = np.zeros(int(offs[hi] - offs[lo]) + 8, np.uint8)
        buf[:-8] = data[offs[lo]:offs[hi]]
        yield lo, hi, buf, offs[lo:hi + 1] - offs[lo]
        lo = hi


def parts(text: bytes, gap: re.Pattern, most: int = SLICE_BYTES) -> Iterator[bytes]:
    """A text cut into parts of about ``most`` bytes, in front of a ``gap``."""
    lo = 0
    while len(text) - lo > most:
        found = gap.search(text, lo + most)
        hi = found.start() if found else len(text)
        yield text[lo:hi]
        lo = hi
    yield text[lo:]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (all arithmetic is modulo 2^64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the words ``[^\\x20\\x09-\\x0D]+``;
    a word never crosses a document."""
    n = int(offs[-1])
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    m = (buf[:n] - np.uint8(9) > 4) & (buf[:n] != 32)
    cut = offs[(offs > 0) & (offs < n)]
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    first[cut], last[cut - 1] = m[cut], m[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.repeat(np.arange(len(offs) - 1), np.diff(np.searchsorted(starts, offs)))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of every span, eight bytes at a step."""
    lanes = np.ndarray((len(buf) - 7,), "<u8", buffer=buf, strides=(1,))
    length = ends - starts
    h = mix(length.astype(np.uint64) * _GOLD + np.uint64(seed))
    live, done = None, 0
    while True:
        if live is None:
            at, left = starts, length
        else:
            at, left = starts[live] + done, length[live] - done
        x = lanes[at] & _LOW[np.minimum(left, 8)]
        if live is None:
            h = mix(h ^ x)
            live = np.flatnonzero(length > 8)
        else:
            h[live] = mix(h[live] ^ x)
            live = live[left > 8]
        done += 8
        if not len(live):
            return h


def multipliers(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLD + np.uint64(seed)) | np.uint64(1)


def window_hashes(words: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hash of each ``n`` consecutive values (at their first position)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    m = len(words) - n + 1
    h = np.zeros(m, np.uint64)
    for k, c in enumerate(multipliers(n, seed)):
        h += words[k:k + m] * c
    return mix(h)


def segment_order(seg: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by segment, and where each of the ``n`` segments starts."""
    small = seg.astype(np.uint16) if n <= 1 << 16 else seg
    return np.argsort(small, kind="stable"), np.concatenate(
        [[0], np.cumsum(np.bincount(seg.astype(np.int64), minlength=n))])


def segment_of_document(docs: np.ndarray, n: int) -> np.ndarray:
    """Segment by a hash of the document, for what needs no other rows: a
    value that very many documents share does not gather in its segment."""
    return mix(docs.astype(np.int64).view(np.uint64) * _GOLD) % np.uint64(n)


def runs(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and lengths of the runs of equal neighbours."""
    if not len(docs):
        return docs.astype(np.int64), np.zeros(0, np.int32)
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
    return docs[first].astype(np.int64), np.diff(np.append(first, len(docs))).astype(np.int32)


def joined(table: pa.Table, name: str, dtype) -> np.ndarray:
    """The packed arrays of a column behind one another."""
    data, _ = binary_parts(table.column(name))
    return np.frombuffer(data.tobytes(), dtype)


def binary_rows(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """One binary value per run of ``lengths`` items of ``values``."""
    offs = np.concatenate([[0], np.cumsum(lengths.astype(np.int64) * values.itemsize)])
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths),
        [None, pa.py_buffer(offs.astype(np.int64).tobytes()),
         pa.py_buffer(np.ascontiguousarray(values).tobytes())]).cast(pa.binary())


def per_document(docs: np.ndarray, values: np.ndarray, out: str) -> pa.Table:
    """``doc_id, <out>``: the values of each document packed into a row."""
    order = np.argsort(docs, kind="stable")
    ids, lengths = runs(docs[order])
    return pa.table({"doc_id": pa.array(ids, pa.int64()), out: binary_rows(values[order], lengths)})
