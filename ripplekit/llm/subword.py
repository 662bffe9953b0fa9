"""Supervised subword embeddings: a text classifier of averaged vectors.

Every word and every character n-gram (UTF-8 bytes of a word with its
borders) is hashed to a row of an embedding table.  A document is the
average of its rows; a softmax layer turns it into class probabilities.  Both
layers are learned by stochastic gradient descent in numpy, in one task, on a
bounded sample of labelled rows.  A word equal to the word before it also
counts as the feature *repeat*.

As everything behind the embeddings is linear, a fitted model is one table
of a row of class weights per hash bucket: scoring a text adds up such rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplekit.llm import common as C

SAMPLE_ROWS = 4000   # labelled rows that a model is fitted on, at most
BITS = 17            # log2 of the number of hash buckets
DIM = 16
EPOCHS = 6
RATE = 0.5
_SPACES = np.array([32 if b in (9, 10, 11, 12, 13) else b for b in range(256)], np.uint8)


@dataclass(frozen=True)
class Model:
    classes: tuple            # label of every class
    weights: np.ndarray       # float32 [bucket, class]
    bias: np.ndarray          # float64 [class]
    ngrams: tuple[int, ...]
    bits: int


def _features(buf, offs, ngrams, bits):
    """Arrays of buckets and where each document's part of them starts."""
    shift = np.uint64(64 - bits)
    starts, ends, doc = C.word_spans(buf, offs)
    words = C.word_hashes(buf, starts, ends, 5)
    n = int(offs[-1])
    every = np.arange(len(offs))
    yield (words >> shift).astype(np.int64), np.searchsorted(doc, every)
    again = np.flatnonzero((words[1:] == words[:-1]) & (doc[1:] == doc[:-1])) + 1
    yield np.zeros(len(again), np.int64), np.searchsorted(doc[again], every)
    space = C._SPACE[buf]
    plain = _SPACES[buf]
    lanes = np.ndarray((n,), "<u8", buffer=plain, strides=(1,))
    for k in ngrams:
        ok = np.ones(n, bool)
        for i in range(1, k - 1):
            ok[:max(0, n - i)] &= ~space[i:n]
        for i in range(1, k):   # not over the end of a document
            last = offs[1:] - i
            ok[last[last >= offs[:-1]]] = False
        at = np.flatnonzero(ok)
        gram = (lanes[at] & C._LOW[k]) * C._GOLD + np.uint64(k)
        yield (C.mix(gram) >> shift).astype(np.int64), np.searchsorted(at, offs)


def _sample_rows(ngrams, bits):
    """``label, idx, weight``: the hashed features of labelled rows."""
    def run(batches):
        for b in batches:
            out_i, out_w = [], []
            for lo, hi, buf, offs in C.slices(b):
                parts = list(_features(buf, offs, ngrams, bits))
                for d in range(hi - lo):
                    idx, cnt = np.unique(np.concatenate([f[s[d]:s[d + 1]] for f, s in parts]), return_counts=True)
                    out_i.append(idx.astype(np.uint32).tobytes())
                    out_w.append((cnt / max(1, cnt.sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("label"), pa.array(out_i, pa.binary()), pa.array(out_w, pa.binary())],
                names=["doc_id", "label", "idx", "weight"])
    return run


def sgd(rows: list[tuple[int, np.ndarray, np.ndarray]], n_classes: int, bits: int, dim: int = DIM,
        epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray]:
    """Fit on ``(class, buckets, weights)``; returns the class weights per
    bucket and the bias.  A step moves a document's average by the learning
    rate times the gradient, whatever its length."""
    rng = np.random.default_rng(7)
    emb = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim))
    out = rng.uniform(-0.5, 0.5, (dim, n_classes))
    share = np.bincount([r[0] for r in rows], minlength=n_classes) + 1.0
    bias = np.log(share / share.sum())
    for epoch in range(epochs):
        lr = rate * (1 - epoch / epochs)
        for i in rng.permutation(len(rows)):
            y, idx, w = rows[i]
            if not len(idx):
                continue
            rows_e = emb[idx]
            h = w @ rows_e
            z = h @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= lr * np.outer(h, p)
            bias -= 0.01 * lr * p
            emb[idx] = rows_e - np.outer(w / (w @ w), lr * back)
    return (emb @ out).astype(np.float32), bias


def _fit(classes, bits):
    def run(batches):
        rows = []
        for b in batches:
            rows += zip(b.column("doc_id").to_pylist(), b.column("label").to_pylist(),
                        b.column("idx").to_pylist(), b.column("weight").to_pylist())
        rows.sort(key=lambda r: (r[0], r[1], r[2]))
        at = {c: i for i, c in enumerate(classes)}
        weights, bias = sgd([(at[y], np.frombuffer(i, np.uint32), np.frombuffer(w, np.float32))
                             for _, y, i, w in rows], len(classes), bits)
        yield pa.RecordBatch.from_arrays(
            [pa.array([weights.tobytes()], pa.binary()), pa.array([bias.tobytes()], pa.binary())],
            names=["weights", "bias"])
    return run


def train(docs: DataFrame, labelled: DataFrame, classes: tuple, rows: int = SAMPLE_ROWS,
          ngrams: tuple[int, ...] = (3, 4), bits: int = BITS, text_col: str = "text") -> Model:
    """Fit a model on at most ``rows`` rows of ``labelled(doc_id, label
    string)``, picked by a hash of the id, with the texts of ``docs``.
    Rows with a null id or label, or a label that is no class, are left out;
    without any rows every class is equally likely."""
    picked = (labelled.where(F.col("doc_id").isNotNull() & F.col("label").isin(*classes))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(rows))
    texts = C.id_and_text(docs, text_col=text_col).join(F.broadcast(picked), "doc_id")
    fitted = (texts.mapInArrow(_sample_rows(ngrams, bits), "doc_id long, label string, idx binary, weight binary")
              .repartition(1).mapInArrow(_fit(classes, bits), "weights binary, bias binary")).collect()
    if fitted:
        weights = np.frombuffer(fitted[0]["weights"], np.float32).reshape(-1, len(classes))
        bias = np.frombuffer(fitted[0]["bias"], np.float64)
    else:   # no partition at all
        weights, bias = sgd([], len(classes), bits)
    return Model(tuple(classes), weights, bias, ngrams, bits)


def posteriors(text: pa.Array, model: Model) -> np.ndarray:
    """``[row, class]`` probabilities of a column of texts."""
    batch = pa.RecordBatch.from_arrays([text], names=["text"])
    k = len(model.classes)
    out = np.zeros((batch.num_rows, k))
    for lo, hi, buf, offs in C.slices(batch, most=C.SLICE_BYTES // 4):
        total, n = np.zeros((hi - lo, k)), np.zeros(hi - lo)
        for f, s in _features(buf, offs, model.ngrams, model.bits):
            n += np.diff(s)
            for c in range(k):
                run = np.concatenate([[0.0], np.cumsum(model.weights[f, c], dtype=np.float64)])
                total[:, c] += run[s[1:]] - run[s[:-1]]
        out[lo:hi] = total / np.maximum(n, 1)[:, None]
    z = out + model.bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def posterior_column(model: Model, text_col: str = "text") -> Column:
    """``array<double>`` of class probabilities of a text column; a null text
    is empty."""
    @F.arrow_udf("array<double>")
    def scored(text: pa.Array) -> pa.Array:
        p = posteriors(text, model)
        return pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), p.shape[1]).cast(pa.list_(pa.float64()))
    return scored(F.col(text_col))
