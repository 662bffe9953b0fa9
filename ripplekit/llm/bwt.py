"""Burrows-Wheeler transform and common prefixes of a collection of strings,
column by column.

All strings are read from their ends.  Each round inserts the next symbol of
every string that is not finished: the rank of the longer suffix follows from
the rank of the shorter one (symbols smaller than the new one, plus equal
ones before it), and its common prefix with either neighbour is one more than
the least common prefix between the shorter suffix and the nearest equal
symbol.  The transform and the common prefixes lie in two external files that
each round reads once from front to back and writes anew.
"""

from __future__ import annotations

import numpy as np

from ripplekit.llm.common import spill_file


class _Column:
    """An array in a spill file, replaced as a whole; the file goes with the
    object."""

    def __init__(self, dtype):
        self.dtype, self.file, self.n = dtype, spill_file(), 0

    def write(self, values: np.ndarray) -> None:
        self.file.seek(0)
        values.astype(self.dtype, copy=False).tofile(self.file)
        self.file.flush()
        self.n = len(values)

    def read(self) -> np.ndarray:
        self.file.seek(0)
        return np.fromfile(self.file, self.dtype, self.n)

    def close(self) -> None:
        self.file.close()


def _by_symbol(bwt: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions grouped by symbol, and where each symbol's group starts."""
    return np.argsort(bwt, kind="stable"), np.concatenate(
        [[0], np.cumsum(np.bincount(bwt, minlength=size))])


def _least(lcp: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(lcp[lo:hi]) for every pair with lo < hi."""
    if not len(lo):
        return np.zeros(0, lcp.dtype)
    order = np.argsort(lo, kind="stable")
    cuts = np.empty(2 * len(lo), np.int64)
    cuts[0::2], cuts[1::2] = lo[order], hi[order]
    out = np.empty(len(lo), lcp.dtype)
    out[order] = np.minimum.reduceat(np.append(lcp, lcp[-1:]), cuts)[0::2]
    return out


def collection_bwt(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Transform (symbol 0 ends a string, others are the values of ``data`` in
    their order, numbered from 1) and common prefixes (with the suffix
    before) of the strings ``data[offs[i]:offs[i + 1]]``."""
    n = len(offs) - 1
    lens = np.diff(offs)
    used, text = np.unique(data, return_inverse=True)
    size = len(used) + 1
    kind = np.uint8 if size <= 256 else np.uint16 if size <= 1 << 16 else np.uint32
    text = (text + 1).astype(kind)

    def symbol(who, t):
        """Symbol before the suffix of t symbols: 0 for the whole string."""
        at = offs[1:][who] - t - 1
        whole = lens[who] == t
        return np.where(whole, 0, text[np.where(whole, 0, at)] if len(text) else 0).astype(kind)

    bwt_file, lcp_file = _Column(kind), _Column(np.uint16)
    try:
        live = np.arange(n)
        bwt_file.write(symbol(live, 0))
        lcp_file.write(np.zeros(n, np.uint16))
        pos = np.arange(n)
        for t in range(1, int(lens.max(initial=0)) + 1):
            keep = lens[live] >= t
            live, pos = live[keep], pos[keep]
            bwt, lcp = bwt_file.read(), lcp_file.read()
            order, first = _by_symbol(bwt, size)
            c = bwt[pos].astype(np.int64)
            # place of each occurrence among all, grouped by symbol
            place = np.empty(len(bwt), np.int32)
            place[order] = np.arange(len(bwt))
            idx = place[pos].astype(np.int64)
            rank = n + idx - first[1]    # behind the n empty suffixes
            before = np.flatnonzero(idx > first[c])
            after = np.flatnonzero(idx + 1 < first[c + 1])
            here, behind = np.zeros(len(live), np.uint16), np.zeros(len(live), np.uint16)
            here[before] = _least(lcp, order[idx[before] - 1] + 1, pos[before] + 1) + 1
            behind[after] = _least(lcp, pos[after] + 1, order[idx[after] + 1] + 1) + 1
            old = np.ones(len(bwt) + len(live), bool)
            old[rank] = False
            new_bwt, new_lcp = np.empty(len(old), kind), np.empty(len(old), np.uint16)
            new_bwt[old], new_lcp[old] = bwt, lcp
            new_bwt[rank] = symbol(live, t)
            nxt = after   # a neighbour with another first symbol stays at 0
            new_lcp[rank[nxt] + 1] = behind[nxt]
            new_lcp[rank] = here
            bwt_file.write(new_bwt)
            lcp_file.write(new_lcp)
            pos = rank
        return bwt_file.read(), lcp_file.read()
    finally:
        bwt_file.close()
        lcp_file.close()


def repeated_starts(data: np.ndarray, offs: np.ndarray, length: int) -> list[np.ndarray]:
    """For every string the starts of its substrings of ``length`` that also
    start elsewhere in the collection."""
    n = len(offs) - 1
    lens = np.diff(offs)
    bwt, lcp = collection_bwt(data, offs)
    order, first = _by_symbol(bwt, int(bwt.max(initial=0)) + 2)
    step = np.empty(len(bwt), np.int64)
    step[order] = np.arange(len(bwt)) + n - first[1]
    long = lcp >= length
    hit = long | np.append(long[1:], False)
    # Walk all strings backwards: the rank of every suffix, one round a symbol.
    out: list[list[np.ndarray]] = []
    pos, live = np.arange(n), np.arange(n)
    for t in range(1, int(lens.max(initial=0)) + 1):
        keep = lens[live] >= t
        live, pos = live[keep], step[pos[keep]]
        if t >= length:
            found = live[hit[pos]]
            out.append(np.stack([found, lens[found] - t]))
    pairs = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
    pairs = pairs[:, np.lexsort((pairs[1], pairs[0]))]
    return np.split(pairs[1], np.searchsorted(pairs[0], np.arange(1, n)))
