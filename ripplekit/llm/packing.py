"""Packing documents into token sequences by best-fit decreasing.

1. *Tokenise* in the scan: a document's ids and an end id, cut into full
   windows of ``window`` tokens and a rest.  Only the pieces' places and
   lengths (and, on request, the ids) leave the task.
2. *Deal* the pieces into buckets of about ``BUCKET_PIECES`` by a hash of
   document and place; the number of buckets follows the number of pieces.
3. *Pack* every bucket: pieces by falling length, each into the open window
   with the least room that still fits, found with a segment tree over
   remaining capacity; otherwise a new window.  A full window is a sequence
   of its own.

Every bucket may leave a few windows partly empty, a share that does not
grow with the corpus.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from ripplekit.llm import common as C
from ripplekit.plans.lineage import materialize

WINDOW = 2048
END_ID = 1
BUCKET_PIECES = 1 << 13
KNOWN_WORDS = 600_000   # that a Python worker remembers; beyond it only the frequent ones stay

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER, _STOP = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[97:123] = True
_STOP[[44, 46]] = True


class _Growing:
    """An array that doubles its room when it is full."""

    def __init__(self, dtype):
        self.room, self.n = np.zeros(1 << 16, dtype), 0

    def append(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.room):
            self.room = np.resize(self.room, 2 * (self.n + len(more)))
        self.room[self.n:self.n + len(more)] = more
        self.n += len(more)

    @property
    def values(self) -> np.ndarray:
        return self.room[:self.n]


class _Codes:
    """Hash table from word hashes to numbers counted from 0, with open
    addressing; whole arrays are looked up and added at once."""

    def __init__(self):
        self.keys, self.checks = _Growing(np.uint64), _Growing(np.uint64)
        self._place(1 << 16)

    def _place(self, slots: int) -> None:
        self.mask = np.uint64(slots - 1)
        self.slot_key, self.slot_code = np.zeros(slots, np.uint64), np.full(slots, -1, np.int32)
        self._insert(self.keys.values, np.arange(self.keys.n))

    def _insert(self, keys: np.ndarray, codes: np.ndarray) -> None:
        at = keys & self.mask
        while len(keys):
            free = np.flatnonzero(self.slot_code[at] < 0)
            _, first = np.unique(at[free], return_index=True)   # one word a slot
            put = free[first]
            self.slot_key[at[put]], self.slot_code[at[put]] = keys[put], codes[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, codes, at = keys[rest], codes[rest], (at[rest] + np.uint64(1)) & self.mask

    def add(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Numbers of new words."""
        codes = np.arange(self.keys.n, self.keys.n + len(keys))
        self.keys.append(keys)
        self.checks.append(checks)
        if 2 * self.keys.n > len(self.slot_key):
            self._place(1 << (4 * self.keys.n).bit_length())
        else:
            self._insert(keys, codes)
        return codes

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for unknown ones."""
        out = np.full(len(keys), -1, np.int64)
        at, live = keys & self.mask, np.arange(len(keys))
        while len(live):
            code, same = self.slot_code[at], self.slot_key[at] == keys[live]
            hit = (code >= 0) & same
            out[live[hit]] = code[hit]
            on = np.flatnonzero((code >= 0) & ~same)
            live, at = live[on], (at[on] + np.uint64(1)) & self.mask
        known = np.flatnonzero(out >= 0)
        out[known[self.checks.values[out[known]] != checks[known]]] = -1
        return out


class WordIds:
    """Ids of whole texts, word by word.

    The tokenizer lower-cases and never joins characters across white space,
    so the ids of a text are those of its lower-case words (runs without
    ASCII white space) in order, and it is asked for a word once; after that a
    word is known by 128 bits of hash.  A full stop or comma between an ASCII
    letter and white space is a token group of its own, so it counts as a
    word.  Words of letters only are one token group each: many are given to
    the tokenizer in one text, and the ids that end a group tell them apart."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs the tasks side by side
        self.tokenizer = Tokenizer.from_file(path)
        # for words of a-z, which its first two steps only pass on
        self.of_letters = Tokenizer.from_file(path)
        self.of_letters.normalizer = normalizers.Sequence([])
        self.of_letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.empty()

    def empty(self) -> None:
        self.codes = _Codes()
        self.flat, self.first, self.lens = _Growing(np.uint32), _Growing(np.int64), _Growing(np.int64)
        self.seen = np.zeros(0, np.int64)   # how often each word came

    def forget(self) -> None:
        """Keep the most frequent half of the words that may be known."""
        kept = np.argsort(-self.seen, kind="stable")[:KNOWN_WORDS // 2]
        kept = kept[self.seen[kept] > 1]
        keys, checks, seen = self.codes.keys.values[kept], self.codes.checks.values[kept], self.seen[kept]
        flat, lens = self._gather(kept), self.lens.values[kept]
        self.empty()
        self._add(keys, checks, flat, np.cumsum(lens) - lens, lens)
        self.seen[:] = seen // 2

    def _add(self, keys, checks, flat, first, lens) -> np.ndarray:
        """Take in words whose ids are ``lens`` of ``flat`` from ``first`` on."""
        self.first.append(self.flat.n + first)
        self.lens.append(lens)
        self.flat.append(flat)
        self.seen = np.append(self.seen, np.zeros(len(keys), np.int64))
        return self.codes.add(keys, checks)

    def _gather(self, codes: np.ndarray) -> np.ndarray:
        """Ids of the words of these numbers, one behind the other."""
        lens = self.lens.values[codes]
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(codes) else 0
        return self.flat.values[np.arange(total) + np.repeat(self.first.values[codes] - (ends - lens), lens)]

    def _ids(self, texts: list[str], tokenizer: Tokenizer | None = None) -> list[list[int]]:
        return [e.ids for e in (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[bytes], keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Numbers of new words, each with the ids that the tokenizer gives
        for the word alone."""
        texts = [w.decode() for w in words]
        kinds: list[list[int]] = [[], [], []]   # of a-z, of letters, others
        for i, (w, t) in enumerate(zip(words, texts)):
            kinds[2 if not (t.isalpha() and t.lower().isalpha()) else 0 if w.isalpha() and w.islower() else 1].append(i)
        *plain, rest = kinds
        parts = []   # numbers in the list, ids, ids per word
        for letters, tokenizer in zip(plain, (self.of_letters, self.tokenizer)):
            for lo in range(0, len(letters), 1000):
                part = letters[lo:lo + 1000]
                ids = np.array(self._ids([" ".join([texts[i] for i in part])], tokenizer)[0], np.uint32)
                last = np.flatnonzero(self.ends[ids])
                if len(last) == len(part):
                    parts.append((part, ids, np.diff(last, prepend=-1)))
                else:
                    rest += part
        if rest:
            each = self._ids([texts[i] for i in rest])
            parts.append((rest, np.fromiter(chain.from_iterable(each), np.uint32),
                          np.fromiter(map(len, each), np.int64, len(each))))
        order = np.concatenate([p[0] for p in parts]).astype(np.int64)
        flat, lens = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
        codes = np.empty(len(words), np.int64)
        codes[order] = self._add(keys[order], checks[order], flat, np.cumsum(lens) - lens, lens)
        return codes

    def __call__(self, buf: np.ndarray, offs: np.ndarray) -> list[np.ndarray]:
        """Ids of every text of a slice (``common.slices``)."""
        if self.codes.keys.n > KNOWN_WORDS:
            self.forget()
        buf = _lower(buf, offs)
        starts, ends, doc = _words(buf, offs)
        keys, checks = (C.word_hashes(buf, starts, ends, seed) for seed in (0x5EED, 0xC0DE))
        codes = self.codes.find(keys, checks)
        missing = np.flatnonzero(codes < 0)
        if len(missing):
            _, one, of = np.unique(keys[missing], return_index=True, return_inverse=True)
            new = missing[one]
            data = buf.tobytes()
            words = [data[a:z] for a, z in zip(starts[new].tolist(), ends[new].tolist())]
            codes[missing] = self.learn(words, keys[new], checks[new])[of]
        self.seen += np.bincount(codes, minlength=len(self.seen))
        ids = self._gather(codes)
        words_before = np.searchsorted(doc, np.arange(len(offs)))
        at = np.concatenate([[0], np.cumsum(self.lens.values[codes])])[words_before]
        return [ids[a:z] for a, z in zip(at[:-1].tolist(), at[1:].tolist())]


def _lower(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """A-Z in lower case, but not in texts with combining marks (U+0300 and
    behind): the tokenizer composes characters before it lower-cases, and some
    compositions exist for small letters only."""
    low = _LOWER[buf]
    marks = np.flatnonzero((buf == 0xCC) | (buf == 0xCD))
    for d in np.unique(np.searchsorted(offs, marks, "right") - 1).tolist():
        low[offs[d]:offs[d + 1]] = buf[offs[d]:offs[d + 1]]
    return low


def _words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the words, with a full stop or
    comma behind a letter as a word of its own."""
    starts, ends, doc = C.word_spans(buf, offs)
    stop = _STOP[buf[ends - 1]] & _LETTER[buf[ends - 2]] & (ends - starts > 1)
    at = np.repeat(np.arange(len(starts)), 1 + stop)
    second = np.flatnonzero(np.concatenate([[False], at[1:] == at[:-1]])) if len(at) else at
    starts, ends = starts[at], ends[at]
    starts[second] = ends[second] - 1
    ends[second - 1] -= 1
    return starts, ends, doc[at]


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> WordIds:
    return WordIds(path)


def _pieces(path: str, window: int, end_id: int, with_ids: bool, keep_words: bool):
    def run(batches):
        tok = _tokenizer(path)
        yield from pieces(tok, batches)
        if not keep_words:
            tok.empty()

    def pieces(tok, batches):
        end = np.array([end_id], np.uint32)
        kept = "<u2" if len(tok.ends) <= 1 << 16 else "<u4"
        for b in batches:
            rows = [[], [], [], [], [], []]
            doc_ids = b.column("doc_id").to_pylist()
            for lo, hi, buf, offs in C.slices(b):
                for doc, ids in zip(doc_ids[lo:hi], tok(buf, offs)):
                    ids = np.concatenate([ids, end])
                    for start in range(0, len(ids), window):
                        part = ids[start:start + window]
                        for col, v in zip(rows, (doc, start, len(part), zlib.crc32(part.astype("<u4").tobytes()),
                                                 len(ids), part.astype(kept).tobytes() if with_ids else None)):
                            col.append(v)
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in rows[:5]), pa.array(rows[5], pa.binary())],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    return run


class Rooms:
    """Segment tree over remaining capacity: leaf c counts the open windows
    with room for exactly c tokens."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, name: int) -> None:
        self.open[room].append(name)
        i = self.leaves + room
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return the window with the least room >= ``need``."""
        i = self.leaves + need
        if not self.count[i]:
            # climb to the nearest right neighbour that is not empty
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.leaves
        while i:
            self.count[i] -= 1
            i >>= 1
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece (lengths of 1 to ``window``)."""
    seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, n = Rooms(window), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = rooms.take(need)
        if found is None:
            found, n = (window, n), n + 1
        room, s = found
        seq[i], off[i] = s, window - room
        if room > need:
            rooms.add(room - need, s)
    return seq, off


def _pack(window: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("start").to_numpy(), table.column("doc_id").to_numpy()))
        table = table.take(pa.array(order))
        seq, off = best_fit_decreasing(table.column("length").to_numpy(), window)
        base = table.column("bucket").to_numpy() << 32
        return table.drop_columns(["bucket"]).append_column("sequence_id", pa.array(base + seq)) \
            .append_column("offset", pa.array(off))
    return run


def pack(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, tokenizer: str | None = None,
         with_ids: bool = True, keep_words: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens[, ids], sequence_id,
    offset``: one row per piece; ``ids`` are little-endian, of 16 bits if all
    ids of the tokenizer fit, else of 32; ``ids_crc32`` is of 32-bit ids.

    A null text is empty: its only id is the end id.  Rows without an id are
    left out; a row that repeats is packed again; other columns are not read.
    ``tokenizer`` is the path of a tokenizer file that every executor has;
    ``keep_words`` lets Python workers remember words from task to task
    (faster, but their memory stays taken while they wait); the tokens of an added token's text are what the tokenizer says."""
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    cols = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
    pieces = C.id_and_text(docs, id_col, text_col).mapInArrow(
        _pieces(path, window, end_id, with_ids, keep_words), cols + ", ids binary")
    if not with_ids:
        pieces = pieces.drop("ids")
    pieces = materialize(pieces, "pieces")
    n = max(1, -(-pieces.count() // BUCKET_PIECES))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start"), F.lit(n)))
    out = cols + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"
    return dealt.groupBy("bucket").applyInArrow(_pack(window), out)
