"""Licence scan with a generalised suffix automaton of licence words.

1. *Automaton.*  All templates and phrases, as words, go into one suffix
   automaton; a state knows where its words end in which template.
2. *Matching statistics.*  A text is streamed through it word by word: after
   every word the state holds the longest run of words, ending there, that
   occurs in some template.  Words that with their neighbour form no pair of
   any template cannot lie in a match of two words and are passed over.  A
   phrase ends at a word if its state is the current one or lies behind it on
   the suffix links.
3. *Matches.*  Wherever a place in a template does not go on as the text does,
   a match ends; places that share only a shorter run with the text are found
   behind the state, on its suffix links.  So a template's match is seen also
   while another template goes on.
4. *Chains.*  Matches of ``min_match`` words or more are chained per template,
   in order in both the text and the template, with at most ``gap`` words
   between neighbours.  A chain that covers the share
   ``cover`` of its template is a span with the template's label.

The scan needs no shuffle; a long text goes through in parts, the automaton's
state is carried from part to part.
"""

from __future__ import annotations

import re
from collections import deque
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.llm import common as C
from ripplekit.llm.license_texts import PHRASES, TEMPLATES

MIN_MATCH = 4   # words of a match that can be part of a chain
GAP = 12        # words between neighbours of a chain, in text and template
COVER = 0.75    # of a template

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")

_BASE = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64())])
_SPAN = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()),
                   ("last_word", pa.int64()), ("covered", pa.int64()), ("share", pa.float64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("base", pa.list_(_BASE)),
                  ("spans", pa.list_(_SPAN)), ("score", pa.float64())])
_OUT_SQL = ("doc_id long, n_words long, base array<struct<label string, first_word long, n_words long>>, "
            "spans array<struct<label string, template int, first_word long, last_word long, covered long, "
            "share double>>, score double")


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, A-Z in lower case."""
    return _WORD.findall(text.lower())


class Automaton:
    """Generalised suffix automaton of word sequences.

    ``step`` per state: word number -> state; ``link``: the state of the
    longest suffix that ends at other places too; ``length``: words of a
    state's longest string; ``ends``: (sequence, end) where a prefix of a
    sequence is the state's longest string."""

    def __init__(self, sequences: list[list[bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[list[tuple[int, int]]] = [[]]
        self.whole: list[int] = []   # the state of every whole sequence
        pairs = set()
        for s, seq in enumerate(sequences):
            at, before = 0, -1
            for i, w in enumerate(seq):
                c = self.vocabulary.setdefault(w, len(self.vocabulary))
                if before >= 0:
                    pairs.add((before, c))
                at, before = self._extend(at, c), c
                self.ends[at].append((s, i + 1))
            self.whole.append(at)
        self.pairs = np.array(sorted(a * len(self.vocabulary) + b for a, b in pairs), np.int64)
        self.suffixes_of: list[list[int]] = [[] for _ in self.link]
        for v, u in enumerate(self.link):
            if u >= 0:
                self.suffixes_of[u].append(v)
        self._places: dict[int, list[tuple[int, int, int]]] = {}

    def _state(self, length: int, step: dict[int, int], link: int) -> int:
        self.step.append(step)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.link) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """The strings of ``q`` that end a step behind ``p`` get a state of their own."""
        copy = self._state(self.length[p] + 1, dict(self.step[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, p: int, c: int) -> int:
        q = self.step[p].get(c)
        if q is not None:   # an earlier sequence has these words
            return q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        new = self._state(self.length[p] + 1, {}, 0)
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def places(self, v: int, least: int) -> list[tuple[int, int, int]]:
        """(sequence, end, length at most) of the places that share ``least``
        words or more with a state's strings, up to their end."""
        if v not in self._places:
            found, seen, u = [], -1, v
            while u > 0 and self.length[u] >= least:   # each state's own places, then those behind it
                todo = [u]
                while todo:
                    w = todo.pop()
                    found += [(*place, self.length[u]) for place in self.ends[w]]
                    todo += [x for x in self.suffixes_of[w] if x != seen]
                seen, u = u, self.link[u]
            self._places[v] = found
        return self._places[v]


class Scanner:
    """Automaton, phrases and templates of a scan."""

    def __init__(self, phrases, templates, min_match: int, gap: int, cover: float):
        self.min_match, self.gap, self.cover = min_match, gap, cover
        texts = [words_of(t.encode()) for t, _ in phrases] + [words_of(t.encode()) for _, t in templates]
        self.labels = [label for _, label in phrases] + [label for label, _ in templates]
        self.n_words = [len(t) for t in texts]
        self.first_template = len(phrases)
        self.automaton = a = Automaton(texts)
        # word numbers of every sequence, and -1 behind its end
        self.numbers = [[a.vocabulary[w] for w in t] + [-1] for t in texts]
        # phrases that end wherever a state is reached in full
        at_state: dict[int, list[int]] = {}
        for p in range(len(phrases)):
            if texts[p]:
                at_state.setdefault(a.whole[p], []).append(p)
        self.full = [at_state.get(v, []) for v in range(len(a.link))]
        self.behind: list[list[int]] = [[] for _ in a.link]
        for v in sorted(range(1, len(a.link)), key=a.length.__getitem__):
            u = a.link[v]
            self.behind[v] = self.behind[u] + self.full[u]
        self.single = {c: p for c, v in a.step[0].items() if (p := self.full[v]) and a.length[v] == 1}


class Stream:
    """One text on its way through the automaton."""

    def __init__(self, scanner: Scanner):
        self.scanner = scanner
        self.n, self.before = 0, -1            # words so far, number of the last one
        self.at, self.v, self.len = -2, 0, 0   # last word that was streamed, state and length there
        # template, first word, end, first word and end in the template
        self.matches: list[tuple[int, int, int, int, int]] = []
        self.base: list[tuple[int, int]] = []           # phrase, first word

    def feed(self, words: list[bytes]) -> None:
        if not words:
            return
        a = self.scanner.automaton
        ids = np.fromiter(map(a.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        for c, phrases in self.scanner.single.items():   # phrases of one word
            self.base += [(p, self.n + int(i)) for i in np.flatnonzero(ids == c) for p in phrases]
        ids, start = np.append(self.before, ids), self.n - 1
        code = np.where((ids[:-1] >= 0) & (ids[1:] >= 0), ids[:-1] * len(a.vocabulary) + ids[1:], -1)
        at = np.minimum(np.searchsorted(a.pairs, code), max(0, len(a.pairs) - 1))
        pair = np.flatnonzero(a.pairs[at] == code) if len(a.pairs) else np.zeros(0, np.int64)
        if len(pair):
            cut = np.flatnonzero(np.diff(pair) > 1)
            for lo, hi in zip(pair[np.append(0, cut + 1)].tolist(), pair[np.append(cut, len(pair) - 1)].tolist()):
                if self.at == start + lo:   # streamed in the part before
                    lo += 1
                else:
                    self._end()
                    self.v = self.len = 0
                self._run(ids[lo:hi + 2].tolist(), start + lo)
        self.n += len(words)
        self.before = int(ids[-1])

    def _run(self, ids: list[int], at: int) -> None:
        s, a = self.scanner, self.scanner.automaton
        step, link, length = a.step, a.link, a.length
        v, n = self.v, self.len
        for i, c in enumerate(ids, at):
            if n >= s.min_match:
                self._note(v, n, i, c)
            if c not in step[v]:
                while v and c not in step[v]:
                    v = link[v]
                n = length[v]
            v = step[v][c]   # every word here is one of the vocabulary, a step from the root
            n += 1
            if n > 1:
                for p in s.behind[v]:
                    if s.n_words[p] > 1:
                        self.base.append((p, i + 1 - s.n_words[p]))
                if n == length[v]:
                    self.base += [(p, i + 1 - s.n_words[p]) for p in s.full[v]]
        self.v, self.len, self.at = v, n, at + len(ids) - 1

    def _note(self, v: int, n: int, at: int, c: int) -> None:
        """The matches that end in front of word ``at``, which is ``c``."""
        s = self.scanner
        for t, end, most in s.automaton.places(v, s.min_match):
            if t >= s.first_template and s.numbers[t][end] != c:
                m = min(n, most)
                self.matches.append((t, at - m, at, end - m, end))

    def _end(self) -> None:
        if self.len >= self.scanner.min_match:
            self._note(self.v, self.len, self.at + 1, -2)
        self.len = 0

    def chains(self) -> list[tuple[int, int, int, int]]:
        """(template, first word, last word, covered words) of every chain."""
        self._end()
        s = self.scanner
        by_template: dict[int, list[tuple[int, int, int, int]]] = {}
        for t, *match in self.matches:
            by_template.setdefault(t, []).append(tuple(match))
        found = []
        for t, ms in by_template.items():
            ms.sort()
            best, prior, near = [m[1] - m[0] for m in ms], [-1] * len(ms), deque()
            for j, (d0, d1, t0, t1) in enumerate(ms):
                while near and ms[near[0]][0] + s.n_words[t] + s.gap < d0:
                    near.popleft()
                for i in near:
                    e0, e1, u0, u1 = ms[i]
                    if e0 < d0 and e1 < d1 and u0 < t0 and u1 < t1 and d0 - e1 <= s.gap and t0 - u1 <= s.gap:
                        more = best[i] + (d1 - d0) - max(0, e1 - d0, u1 - t0)
                        if more > best[j]:
                            best[j], prior[j] = more, i
                near.append(j)
            used = [False] * len(ms)
            for j in sorted(range(len(ms)), key=lambda j: (-best[j], ms[j])):
                if used[j]:
                    continue
                path = [j]
                while prior[path[-1]] >= 0 and not used[prior[path[-1]]]:
                    path.append(prior[path[-1]])
                for i in path:
                    used[i] = True
                covered = best[j] - (best[prior[path[-1]]] if prior[path[-1]] >= 0 else 0)
                found.append((t, ms[path[-1]][0], ms[j][1] - 1, covered))
        return sorted(found, key=lambda c: (c[1], c[2], c[0]))


@lru_cache(maxsize=4)
def _scanner(phrases, templates, min_match, gap, cover) -> Scanner:
    return Scanner(phrases, templates, min_match, gap, cover)


def _scan(args):
    def run(batches):
        s = _scanner(*args)
        for batch in batches:
            rows = []
            for text in batch.column("text").cast(pa.large_binary()):
                stream = Stream(s)
                for part in C.parts(text.as_py(), _BREAK):
                    stream.feed(words_of(part))
                base = [{"label": s.labels[p], "first_word": i, "n_words": s.n_words[p]}
                        for p, i in sorted(stream.base, key=lambda x: (x[1], x[0]))]
                chains = [(*c, c[3] / s.n_words[c[0]]) for c in stream.chains()]
                spans = [{"label": s.labels[t], "template": t - s.first_template, "first_word": lo, "last_word": hi,
                          "covered": covered, "share": share}
                         for t, lo, hi, covered, share in chains if share >= s.cover]
                rows.append((stream.n, base, spans, 1.0 if base else max((c[4] for c in chains), default=0.0)))
            cols = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(cols, list(_OUT)[1:]))], schema=_OUT)
    return run


def scan(docs: DataFrame, phrases: tuple[tuple[str, str], ...] = PHRASES,
         templates: tuple[tuple[str, str], ...] = TEMPLATES, min_match: int = MIN_MATCH, gap: int = GAP,
         cover: float = COVER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, base, spans, score`` for every row with an id.

    ``base``: every place of a phrase (``phrase, label`` pairs), overlapping
    ones too, by first word; ``spans``: chains that cover the share ``cover``
    of a template (``label, text`` pairs): its number, the first and last word
    of the chain, the template's words that it covers and their share.
    ``score`` is 1 with a phrase, else the largest share of a template that a
    chain covers (0 without any).

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became
    small.  A null or empty text has no words and a score of 0; rows that
    repeat are scanned each; rows without an id are left out; a phrase or
    template without words is found nowhere; other columns are not read."""
    args = (tuple(map(tuple, phrases)), tuple(map(tuple, templates)), min_match, gap, cover)
    return C.id_and_text(docs, id_col, text_col).mapInArrow(_scan(args), _OUT_SQL)


def labels_text(*places: Column) -> Column:
    """Distinct labels of ``base`` or ``spans`` columns, sorted, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.concat(*[p.getField("label") for p in places]))), ",")
