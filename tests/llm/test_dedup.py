"""Substring, suffix-array and SimHash deduplication against brute force."""

import hashlib
import os
import random
import sys
from collections import Counter, defaultdict
from itertools import combinations, product

import duckdb
import numpy as np
import pytest
import xxhash

sys.path.insert(0, os.path.dirname(__file__))

from common_data import frame, odd_texts, rows  # noqa: E402

from ripplekit.llm import bwt, queries, simhash, substring_dedup, suffix_dedup  # noqa: E402
from ripplekit.llm.components import components  # noqa: E402


SF = "/root/testdata/sf0.001"


def words_of(text):
    return (text or "").encode().split()


def brute_substring(docs, n):
    first = {}
    for i, t in docs:
        w = words_of(t)
        for j in range(len(w) - n + 1):
            k = tuple(w[j:j + n])
            first[k] = min(i, first.get(k, i))
    out = []
    for i, t in docs:
        w = words_of(t)
        gone = {p for j in range(len(w) - n + 1) if first[tuple(w[j:j + n])] < i for p in range(j, j + n)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), kept.decode()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [2, 5, 13])
@pytest.mark.parametrize("flush", [10, 1_000_000])
def test_substring_dedup(spark, n, flush, monkeypatch):
    monkeypatch.setattr(substring_dedup, "FLUSH", flush)
    docs = odd_texts()
    got = substring_dedup.substring_dedup(frame(spark, docs, "cells"), n)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_text") == brute_substring(docs, n)


def test_substring_query_and_sql(spark):
    """The registered query, its SQL and brute force on the smallest tables."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in brute_substring(docs, 13)]
    cols = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows(queries.op1_substring_dedup(spark, SF), *cols) == sorted(want, key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.sql(queries.ORACLE["op1_substring_dedup"])
    assert sorted((tuple(dict(zip(rel.columns, r))[c] for c in cols) for r in rel.fetchall()), key=repr) == \
        sorted(want, key=repr)


def test_suffix_query(spark):
    """The registered query with its 400 bytes on the smallest tables."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, gone, spans, hashlib.sha256(kept).hexdigest()) for i, n, gone, spans, kept in brute_suffix(docs, 400)]
    assert rows(queries.op3_suffix_dedup(spark, SF), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert sum(w[2] for w in want) > 0


def test_substring_rows_without_id_and_repeats(spark):
    docs = [(None, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "a b c x")]
    got = rows(substring_dedup.substring_dedup(frame(spark, docs), 3), "doc_id", "n_removed", "kept_text")
    assert got == [(1, 0, "a b c d"), (1, 0, "a b c d"), (2, 3, "x")]


def test_sketch_never_underestimates():
    import pyarrow as pa
    rng = np.random.default_rng(0)
    cells = rng.integers(0, 300, 900).astype(np.uint32)
    docs = np.arange(900, dtype=np.int64)
    t = pa.table({"cells": [cells.tobytes()], "many": [np.zeros(900, np.uint8).tobytes()],
                  "docs": [docs.tobytes()], "lens": [np.ones(900, np.int32).tobytes()],
                  "kcells": [b""], "kdocs": [b""], "klens": [b""]})
    out = substring_dedup._merge_sketches(t)
    got = set(out.column("doc_id").to_pylist())
    n = Counter(cells.tolist())
    assert {int(d) for d, c in zip(docs, cells) if n[int(c)] > 1} <= got


def brute_starts(strings, length):
    n = Counter(s[j:j + length] for s in strings for j in range(len(s) - length + 1))
    return [[j for j in range(len(s) - length + 1) if n[s[j:j + length]] > 1] for s in strings]


def packed(strings):
    return (np.frombuffer(b"".join(strings), np.uint8),
            np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64))


def test_column_wise_construction():
    rng = np.random.default_rng(2)
    for _ in range(150):
        strings = [bytes(rng.integers(0, int(rng.integers(1, 4)), int(rng.integers(0, 14))).astype(np.uint8))
                   for _ in range(int(rng.integers(1, 8)))]
        length = int(rng.integers(1, 6))
        data, offs = packed(strings)
        assert [x.tolist() for x in bwt.repeated_starts(data, offs, length)] == brute_starts(strings, length)
        # transform and common prefixes of the sorted suffixes
        suffixes = sorted((tuple(b + 1 for b in s[j:]) + (0,), i, j) for i, s in enumerate(strings)
                          for j in range(len(s) + 1))
        suffixes.sort(key=lambda x: ([(b, 0) for b in x[0][:-1]] + [(0, 0), (0, x[1])]))
        got_bwt, got_lcp = bwt.collection_bwt(data, offs)
        code = {b: k + 1 for k, b in enumerate(sorted(set(data.tolist())))}
        assert got_bwt.tolist() == [code[strings[i][j - 1]] if j else 0 for _, i, j in suffixes]
        want = [0] + [next((k for k, (p, q) in enumerate(zip(a[0][:-1], b[0][:-1])) if p != q),
                           min(len(a[0]), len(b[0])) - 1) for a, b in zip(suffixes, suffixes[1:])]
        assert got_lcp.tolist() == want


def test_all_byte_values():
    strings = [bytes(range(256)) * 2, bytes(range(100, 256)) + bytes(range(80))]
    assert [x.tolist() for x in bwt.repeated_starts(*packed(strings), 50)] == brute_starts(strings, 50)


def brute_suffix(docs, length):
    texts = [(i, (t or "").encode()) for i, t in docs]
    n = Counter(t[j:j + length] for _, t in texts for j in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for j in range(len(t) - length + 1):
            if n[t[j:j + length]] > 1:
                gone[j:j + length] = b"\1" * length
        spans = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowd,frequent", [(1, 0), (1, 20), (4096, 20)])
def test_suffix_dedup(spark, crowd, frequent, monkeypatch):
    # few bits: no key is frequent, so that crowded keys are met as well
    monkeypatch.setattr(suffix_dedup, "FREQUENT_BITS", frequent)
    docs = odd_texts(1)
    got = suffix_dedup.suffix_dedup(frame(spark, docs, "asks"), 40, gram=10, klass=6, crowd=crowd)
    want = [(a, b, c, d, bytearray(e)) for a, b, c, d, e in brute_suffix(docs, 40)]
    assert [(a, b, c, d, bytearray(e)) for a, b, c, d, e in rows(
        got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept")] == want


def in_this_process(run, docs):
    """Rows of a task function over documents, without Spark."""
    import pyarrow as pa
    batch = pa.record_batch({"doc_id": pa.array([i for i, _ in docs], pa.int64()),
                             "text": pa.array([t or "" for _, t in docs])})
    return [r for b in run([batch]) for r in b.to_pylist()]


def test_collections_and_batches_of_any_size(monkeypatch):
    """Tiny flushes, collections and window batches give the same windows."""
    import pyarrow as pa
    docs = odd_texts(1)
    want = brute_suffix(docs, 40)
    gone_of = {i: n for i, _, n, _, _ in want}
    for flush, collection, windows, crowd in ((20, 1, 3, 4096), (50, 60, 7, 2), (10**6, 10**6, 10**6, 4096)):
        for name, v in (("FLUSH", flush), ("COLLECTION", collection), ("WINDOWS", windows)):
            monkeypatch.setattr(suffix_dedup, name, v)
        entries = in_this_process(suffix_dedup._entries(4, 40, 10, 6, np.zeros(0, np.uint64)), docs)
        asks = defaultdict(list)
        for seg in range(4):
            t = pa.Table.from_pylist([r for r in entries if r["seg"] == seg], pa.schema(
                [("seg", pa.int32()), *((c, pa.binary()) for c in suffix_dedup._ENTRY_COLS)]))
            for r in suffix_dedup._shared_keys(crowd)(t).to_pylist():
                asks[r["doc_id"]].append(r["asks"])
        text = dict(docs)
        asked = pa.record_batch({"doc_id": list(asks), "text": [text[i] or "" for i in asks],
                                 "asks": list(asks.values())})
        spans = defaultdict(list)
        for what, core, step, cols in ((suffix_dedup.SEND, 35, None, suffix_dedup._STRING_COLS),
                                       (suffix_dedup.SPREAD, 0, suffix_dedup._single_windows(4, 40),
                                        suffix_dedup._WINDOW_COLS)):
            rows_ = list(suffix_dedup._strings(4, what, core)([asked]))
            if step:
                rows_ = list(step(rows_))
            merge = suffix_dedup._equal_windows(40) if step else suffix_dedup._suffix_arrays(40, core)
            rows_ = [r for b in rows_ for r in b.to_pylist()]
            for seg in range(4):
                t = pa.Table.from_pylist([r for r in rows_ if r["seg"] == seg], pa.schema(
                    [("seg", pa.int32()), *((c, pa.binary()) for c in cols)]))
                for r in merge(t).to_pylist():
                    spans[r["doc_id"]].append(r["spans"])
        cut = next(iter(suffix_dedup._cut([pa.record_batch({
            "doc_id": list(text), "text": [t or "" for t in text.values()],
            "asks": pa.array([asks.get(i) for i in text], pa.list_(pa.binary())),
            "spans": pa.array([spans.get(i) for i in text], pa.list_(pa.binary()))})])))
        assert {r["doc_id"]: r["n_removed"] for r in cut.to_pylist()} == gone_of


def test_a_passage_on_all_documents_does_not_gather():
    """What is known to repeat spreads over the segments."""
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    footer = " ".join(word() for _ in range(13))
    docs = [(i, " ".join(word() for _ in range(40)) + " " + footer) for i in range(3000)]
    rows_ = in_this_process(substring_dedup._partition_sketches(13, 16), docs)
    known = [len(r["kcells"]) // 4 for r in rows_]
    assert sum(known) >= 2999 and max(known) <= 2 * sorted(known)[len(known) // 2]
    passage = " ".join(word() for _ in range(70))
    docs = [(i, passage + " " + word()) for i in range(3000)]
    rows_ = in_this_process(suffix_dedup._entries(16, 400, 100, 50, np.zeros(0, np.uint64)), docs)
    known = [len(r["kspans"]) for r in rows_]
    assert sum(known) > 0 and max(known) <= 2 * sorted(known)[len(known) // 2]


def test_equal_windows_agree_in_slices_of_any_size():
    """The anchor of a window does not depend on what stands around it."""
    rng = np.random.default_rng(8)
    window = rng.integers(97, 101, 60).astype(np.uint8)
    for n in (60, 70, 1000, 70_000):
        buf = np.concatenate([rng.integers(97, 101, n - 60).astype(np.uint8), window, np.zeros(8, np.uint8)])
        first, last, left, _, key, _ = suffix_dedup._entries_of(buf, np.array([0, n]), 60, 10, 6)
        at = np.flatnonzero((first <= n - 60) & (n - 60 <= last))
        assert len(at) == 1
        keys = {int(key[at[0]])} if n == 60 else keys | {int(key[at[0]])}
    assert len(keys) == 1


def brute_fingerprint(text, n=3):
    w = (text or "").encode().lower().split()
    sh = [b" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_classes(items, distance):
    """Smallest reachable id per (id, fingerprint)."""
    parent = {i: i for i, _ in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for (i, a), (j, b) in combinations(items, 2):
        if bin(a ^ b).count("1") <= distance:
            x, y = sorted((find(i), find(j)))
            parent[y] = x
    return {i: find(i) for i, _ in items}


def test_simhash_fingerprints(spark):
    docs = odd_texts(2)
    got = dict(rows(simhash.simhash(frame(spark, docs, "fp")), "doc_id", "fp"))
    assert {i: f & (2**64 - 1) for i, f in got.items()} == {i: brute_fingerprint(t) for i, t in docs}


def test_spark_hash_is_the_same(spark):
    from pyspark.sql import functions as F
    for s in ("", "abc", "é ß x" * 20):
        h = spark.range(1).select(F.xxhash64(F.lit(s)).alias("h")).first()["h"]
        assert h & (2**64 - 1) == xxhash.xxh64_intdigest(s.encode(), 42)


@pytest.mark.parametrize("meet", [2, 1024])
@pytest.mark.parametrize("parts", [2, 3, 4])
def test_links_lose_nothing(spark, meet, parts, monkeypatch):
    monkeypatch.setattr(simhash, "MEET", meet)
    rnd = random.Random(parts)
    seeds = [rnd.getrandbits(64) for _ in range(25)] + [0]
    fps = list({s ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3)))
                for s in seeds for _ in range(12)})
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = dict(rows(components(simhash.links(df, 2, parts)), "node", "root"))
    want = brute_classes([(k, f) for k, f in enumerate(fps)], 2)
    groups = defaultdict(set)
    for k, f in enumerate(signed):
        groups[roots.get(f, f)].add(k)
    expected = defaultdict(set)
    for k, c in want.items():
        expected[c].add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_thresholds_are_cheapest_and_add_up():
    rng = np.random.default_rng(3)
    for parts, distance in product((2, 3, 4), (2, 4)):
        costs = rng.random((parts, distance + 2, 20))
        costs[:, 0] = 0
        t = simhash.thresholds(costs, distance)
        assert ((t + 1).sum(axis=0) == distance + 1).all()
        for r in range(20):
            best = min(sum(costs[i, a, r] for i, a in enumerate(v))
                       for v in product(range(distance + 2), repeat=parts) if sum(v) == distance + 1)
            assert abs(sum(costs[i, t[i, r] + 1, r] for i in range(parts)) - best) < 1e-9


def test_near_duplicates(spark):
    docs = odd_texts(4) + [(900, None), (901, "ONE two"), (1000, "one"), (1001, "one")]
    got = rows(simhash.near_duplicates(frame(spark, docs, "root")), "doc_id", "component_id")
    assert dict(got) == brute_classes([(i, brute_fingerprint(t)) for i, t in docs], 2)


def test_partition_groups_correlated_bits():
    corr = np.eye(64)
    corr[0, 63] = corr[63, 0] = 0.9
    groups = simhash.partition_bits(corr, 3)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert 63 in groups[0] and 0 in groups[0]


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (200, 201), (201, 200)]
    got = dict(rows(components(spark.createDataFrame(edges, "u long, v long")), "node", "root"))
    assert got == {**{i: 0 for i in range(61)}, 200: 200, 201: 200}


def test_empty_tables(spark):
    none = frame(spark, [])
    assert substring_dedup.substring_dedup(none).count() == 0
    assert suffix_dedup.suffix_dedup(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
