"""Language-model scores, quality classifier and mixing."""

import math
import os
import sys
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from common_data import frame, odd_texts, rows  # noqa: E402

from ripplekit.llm import common as C  # noqa: E402
from ripplekit.llm import lm_scoring, mixing, quality, subword  # noqa: E402
from ripplekit.llm import queries as Q  # noqa: E402

SF = "/root/testdata/sf0.01"


def brute_scores(docs, size):
    words = [(i, (t or "").encode().split()) for i, t in docs]
    total = sum(len(w) for _, w in words)
    n = Counter(x for _, w in words for x in w)
    words = [(i, [x if n[x] * size >= total else None for x in w]) for i, w in words]
    c1 = Counter(x for _, w in words for x in w)
    c2 = Counter(p for _, w in words for p in zip(w, w[1:]))

    def log(x):
        return round(1e6 * math.log(max(x, 1)))
    out = []
    for i, w in words:
        o1, o2 = Counter(w), Counter(zip(w, w[1:]))

        def uni(x):
            return log(c1[x] - o1[x]) - log(total - len(w))
        s = uni(w[0]) if w else 0
        for p in zip(w, w[1:]):
            c = c2[p] - o2[p]
            s += log(c) - log(c1[p[0]] - o1[p[0]]) if c > 0 else round(1e6 * math.log(0.4)) + uni(p[1])
        out.append((i, len(w), s))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size,part,flush", [(65536, 1 << 22, 1 << 20), (16, 7, 30)])
def test_stupid_backoff(spark, size, part, flush, monkeypatch):
    monkeypatch.setattr(lm_scoring, "PART_TOKENS", part)
    monkeypatch.setattr(lm_scoring, "FLUSH", flush)
    docs = odd_texts(5)
    got = lm_scoring.score(frame(spark, docs, "keys"), size)
    assert rows(got, "doc_id", "n_words", "score") == brute_scores(docs, size)


@pytest.mark.parametrize("part,flush", [(1 << 22, 1 << 20), (7, 30)])
def test_stupid_backoff_of_all_words(spark, part, flush, monkeypatch):
    monkeypatch.setattr(lm_scoring, "ALL_PART_TOKENS", part)
    monkeypatch.setattr(lm_scoring, "FREQUENT", 1 << 18 if part > 9 else 16)
    monkeypatch.setattr(lm_scoring, "FLUSH", flush)
    docs = odd_texts(5) + [(1000, "the Quetzal of the"), (1001, "a Quetzal of x"), (1002, "the Okapi of the")]
    # A size of all tokens keeps every word.
    want = brute_scores(docs, sum(len((t or "").split()) for _, t in docs))
    got = lm_scoring.score(frame(spark, docs, "keys"), None)
    assert rows(got, "doc_id", "n_words", "score") == want
    twice = lm_scoring.score(frame(spark, [(1, "a b c"), (1, "a b c"), (1, "c a b"), (2, "a b"), (3, None)]), None)
    each = brute_scores([(1, "a b c"), (4, "a b c"), (5, "c a b"), (2, "a b"), (3, None)], 11)
    s = {i: x for i, _, x in each}
    assert rows(twice, "doc_id", "n_words", "score") == [(1, 9, s[1] + s[4] + s[5]), (2, 2, s[2]), (3, 0, 0)]
    assert lm_scoring.score(frame(spark, []), None).count() == 0


def test_a_pass_hashes_bigrams_once_and_sorts_once(monkeypatch):
    """A scan of a pass does each step on a slice's words once."""
    hashed, words = [], np.array([7, 9, 7, 9, 11], np.uint64) * C._GOLD
    real = C.window_hashes
    monkeypatch.setattr(C, "window_hashes", lambda *a: hashed.append(1) or real(*a))
    monkeypatch.setattr(np, "lexsort", lambda *a: pytest.fail("sorted by two keys"))
    monkeypatch.setattr(lm_scoring, "PASSES", 1)
    order = np.argsort(words[[0, 1]])
    voc = lm_scoring.Vocabulary(words[[0, 1]][order], np.array([5, 4])[order], 30)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a b a b c", "a c"], "text_hash": [3, 4]})
    monkeypatch.setattr(lm_scoring, "_words", lambda b: iter([(0, 2, np.append(words, words[[0, 4]]),
                                                             np.array([0, 0, 0, 0, 0, 1, 1]))]))
    rows = list(lm_scoring._own_pairs(voc, np.ones(4, np.int64), 0)(iter([batch])))
    assert len(hashed) == 1
    own = np.concatenate([np.frombuffer(x, np.uint32) for r in rows for x in r.column("own").to_pylist()])
    assert sorted(own) == [1, 1, 1, 2]      # ab twice, ba, bc; ac


def test_places_of_hashes():
    rng = np.random.default_rng(3)
    for known in (rng.integers(0, 2**64, 1000, np.uint64), np.arange(300, dtype=np.uint64),
                  np.arange(2**64 - 40, 2**64, dtype=np.uint64), np.zeros(0, np.uint64), np.array([5], np.uint64)):
        known = np.unique(known)
        keys = np.concatenate([known, known + np.uint64(1), rng.integers(0, 2**64, 50, np.uint64),
                               np.array([0, 2**64 - 1], np.uint64)])
        at, found = lm_scoring._places(known, keys)
        assert found.tolist() == np.isin(keys, known).tolist()
        assert (known[at[found]] == keys[found]).all()


@pytest.mark.parametrize("docs", [1, 2, 300])
def test_order_by_document_and_value(docs):
    rng = np.random.default_rng(docs)
    doc = np.sort(rng.integers(0, docs, 2000))
    for values in (rng.integers(0, 2**64, 2000, np.uint64), rng.integers(0, 9, 2000).astype(np.uint64)):
        order, size = lm_scoring._ordered(doc, values)
        got = list(zip(doc[order].tolist(), values[order].tolist()))
        assert got == sorted(zip(doc.tolist(), values.tolist()))
        assert size.tolist() == [n for _, n in sorted(Counter(got).items())]
    assert [len(x) for x in lm_scoring._ordered(doc[:0], values[:0])] == [0, 0]


def test_scores_of_an_empty_table(spark):
    assert lm_scoring.score(frame(spark, [])).count() == 0
    assert rows(lm_scoring.score(frame(spark, [(1, None)])), "doc_id", "n_words", "score") == [(1, 0, 0)]


def test_quality_on_held_out_rows(spark):
    got = Q.op4_quality_classifier(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    seen = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    right = seen.where("predicted = quality").count()
    assert right / seen.count() >= 0.95
    assert got.where("score < 0 or score > 1 or score is null").count() == 0


def test_quality_does_not_learn_held_out_labels(spark):
    docs = frame(spark, odd_texts(6))
    labels = docs.select("doc_id").withColumn("quality", F.pmod("doc_id", F.lit(2)).cast("int"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality"))
                               .otherwise(F.col("quality")))
    a, b = (quality.fit_quality(docs, x) for x in (labels, turned))
    assert (a.weights == b.weights).all() and (a.bias == b.bias).all()


def test_quality_without_labels_and_of_odd_texts(spark):
    docs = frame(spark, odd_texts(7), "score")
    none = spark.createDataFrame([], "doc_id long, quality int")
    m = quality.fit_quality(docs, none)
    got = quality.with_quality(docs, m).select("doc_id", "score").collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    nulls = spark.createDataFrame([(1, None), (None, 1), (4, 5)], "doc_id long, quality int")
    assert quality.fit_quality(docs, nulls).bias.tolist() == m.bias.tolist()
    assert quality.with_quality(frame(spark, []), m).count() == 0


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["ab cd ab", "", "x", None, "ab cd ab", "zz zz zz zz"]
    rng = np.random.default_rng(0)
    m = subword.Model(("a", "b"), rng.normal(size=(1 << 10, 2)).astype(np.float32), np.zeros(2), (3, 4), 10)
    whole = subword.posteriors(pa.array(texts), m)
    for k, t in enumerate(texts):
        assert np.allclose(subword.posteriors(pa.array([t], pa.string()), m)[0], whole[k])


def test_sgd_separates():
    rng = np.random.default_rng(1)
    docs = []
    for i in range(200):
        idx = np.unique(rng.integers(0, 400, 30) + 400 * (i % 2))
        docs.append((i % 2, idx, np.full(len(idx), 1 / len(idx), np.float32)))
    w, b = subword.sgd(docs, 2, 10)
    for y, idx, share in docs:
        assert int(np.argmax(share @ w[idx] + b)) == y


def mixture(spark, n=300):
    rng = np.random.default_rng(4)
    data = []
    for i in range(n):
        p = [1.0, 0.0] if i % 3 else [0.25, 0.75]
        data.append((i, int(rng.integers(1, 100)), p))
    return spark.createDataFrame(data, "doc_id long, tokens long, posterior array<double>")


def test_mix_meets_the_targets(spark):
    scored = mixture(spark)
    m = mixing.fit_mix(scored, ("a", "b"), {"a": 0.5, "b": 0.5}, pull=1e-4, steps=200)
    r = scored.withColumn("rate", m.rate(F.col("posterior")))
    assert r.agg(F.min("rate")).first()[0] >= 0
    total = scored.agg(F.sum("tokens")).first()[0]
    for d in range(2):
        got = r.agg(F.sum(F.col("rate") * F.col("tokens") * F.col("posterior")[d])).first()[0]
        assert abs(got / total - 0.5) < 0.01


def test_mix_is_the_least_squares_solution(spark):
    scored = mixture(spark, 60)
    m = mixing.fit_mix(scored, ("a", "b"), {"a": 0.2, "b": 0.8}, pull=0.05, steps=400)
    local = scored.withColumn("rate", m.rate(F.col("posterior"))).collect()
    w = np.array([r.tokens for r in local], float)
    w /= w.sum()
    p = np.array([r.posterior for r in local])

    def loss(r):
        e = ((w * r) @ p - np.array([0.2, 0.8])) / np.sqrt([0.2, 0.8])
        return 0.5 * (e @ e) + 0.5 * 0.05 * (w @ (r - 1) ** 2)
    rate = np.array([r.rate for r in local])
    best, rng = loss(rate), np.random.default_rng(0)
    for _ in range(500):
        assert loss(np.maximum(0, rate + rng.normal(0, 0.05, len(rate)))) >= best - 1e-6


@pytest.mark.parametrize("hot", [0.97, 0.985])
def test_mix_of_rare_domains_meets_the_targets_by_default(spark, hot, caplog):
    shares, weights = [hot] + [(1 - hot) / 3] * 3, {"a": 0.5, "b": 0.2, "c": 0.2, "d": 0.1}
    data = [(10 * i + j, round(1e5 * x), [float(k == i) for k in range(4)])
            for i, x in enumerate(shares) for j in range(10)]
    data += [(100 + j, 50 * j, [0.9, 0.06, 0.03, 0.01]) for j in range(10)]
    scored = spark.createDataFrame(data, "doc_id long, tokens long, posterior array<double>")
    m = mixing.fit_mix(scored, tuple(weights), weights)
    r = scored.withColumn("rate", m.rate(F.col("posterior")))
    total = sum(n for _, n, _ in data)
    for d, t in enumerate(weights.values()):
        got = r.agg(F.sum(F.col("rate") * F.col("tokens") * F.col("posterior")[d])).first()[0]
        assert abs(got / total - t) < 0.001 * t
    assert not caplog.records


def test_mix_reports_a_domain_that_is_not_there(spark, caplog):
    scored = spark.createDataFrame([(i, 10, [1.0, 0.0]) for i in range(20)],
                                   "doc_id long, tokens long, posterior array<double>")
    m = mixing.fit_mix(scored, ("a", "b"), {"a": 0.5, "b": 0.5})
    assert abs(m.errors[0]) < 0.001 and m.errors[1] == -1
    assert [x.args[0] for x in caplog.records] == ["b"]


def test_mix_of_texts(spark):
    texts = [(i, ("the of and to in " if i % 4 else "der die und das zu ") * (i % 5 + 1)) for i in range(80)]
    docs = frame(spark, texts + [(200, None), (201, "")], "rate")
    labelled = spark.createDataFrame([(i, "en" if i % 4 else "de") for i in range(0, 80)], "doc_id long, label string")
    model, m, scored = mixing.mix(docs, labelled, {"en": 0.5, "de": 0.5})
    r = mixing.rated(scored, m)
    total = r.agg(F.sum("tokens")).first()[0]
    de = r.agg(F.sum(F.expr("rate * tokens * posterior[0]"))).first()[0]
    assert abs(de / total - 0.5) < 0.05
    assert r.count() == 82 and r.where("rate is null or copies is null").count() == 0
    out = mixing.with_copies(docs, model, m)
    assert out.columns == docs.columns
    assert out.count() == r.agg(F.sum("copies")).first()[0]


def test_mix_of_nothing(spark):
    none = frame(spark, [])
    model, m, scored = mixing.mix(none, spark.createDataFrame([], "doc_id long, label string"), {"a": 1.0, "b": 1.0})
    assert mixing.rated(scored, m).count() == 0 and mixing.with_copies(none, model, m).count() == 0
    assert m.errors == ()


def test_mixing_query(spark):
    """The registered query against words, posteriors and rates put together
    here: tokens, totals that meet the targets, copies by their draw."""
    got = Q.op8_mixing(spark, SF).collect()
    texts = dict(rows(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text"))
    assert len(got) == len(texts)
    domains = sorted(Q.MIX)
    total = sum(r.tokens for r in got)
    for r in got:
        assert r.tokens == len((texts[r.doc_id] or "").encode().split())
        assert abs(sum(r[f"p_{d}"] for d in domains) - 1) < 0.03
        assert r.rate >= 0 and r.copies in (int(r.rate), int(r.rate) + 1)
    for d in domains:
        assert abs(sum(r.rate * r.tokens * r[f"p_{d}"] for r in got) / total - Q.MIX[d]) < 0.01 * Q.MIX[d]
    # the copies' tokens are near the rates' tokens
    assert abs(sum(r.copies * r.tokens for r in got) / sum(r.rate * r.tokens for r in got) - 1) < 0.1


def plain_steps():
    """Posteriors, and rates by projected steps in numpy."""
    rng = np.random.default_rng(3)
    m = mixing.Mix(("a", "b", "c"), (0.5, 0.3, 0.2), (), tuple(tuple(x) for x in rng.normal(0, 0.3, (9, 4))),
                   (0.5, 2.0, 3.0), 0.4, 1e-3)
    p = rng.dirichlet(np.ones(3), 50)
    rate, last = np.ones(50), np.ones(50)
    for momentum, *excess in m.steps:
        looked = rate + momentum * (rate - last)
        new = np.maximum(0, looked - m.size * (p @ m.reach) * (p @ excess + m.pull * (looked - 1)))
        rate, last = new, rate
    return p, rate, m


def test_rate_column(spark):
    p, want, m = plain_steps()
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(p)], "id long, posterior array<double>")
    got = dict(rows(df.select("id", m.rate(F.col("posterior")).alias("r")), "id", "r"))
    assert np.allclose([got[i] for i in range(len(p))], want, atol=1e-12)


def test_scores_put_together(spark):
    """Scores of the quality model against words and n-grams averaged here."""
    texts = ["ab cd ab", "", "x", None, "zz zz", "\u00e9t\u00e9 ab"]
    rng = np.random.default_rng(1)
    m = subword.Model(("0", "1"), rng.normal(size=(1 << 10, 2)).astype(np.float32), np.array([0.1, -0.2]), (3, 4), 10)
    got = quality.with_quality(frame(spark, list(enumerate(texts))), m).select("doc_id", "score").collect()
    each = subword.posteriors(pa.array(texts), m)
    for r in got:
        assert abs(r.score - each[r.doc_id, 1]) < 1e-8
    prior = np.exp(m.bias) / np.exp(m.bias).sum()
    assert abs(each[1, 1] - prior[1]) < 1e-12 and abs(each[3, 1] - prior[1]) < 1e-12


def test_lm_query_and_sql(spark):
    """The registered query, its SQL and brute force on the smallest tables."""
    small = "/root/testdata/sf0.001"
    docs = rows(spark.read.parquet(f"{small}/documents.parquet"), "doc_id", "text")
    want = brute_scores(docs, sum(len((t or "").split()) for _, t in docs))
    assert rows(Q.op2_lm_scoring(spark, small), "doc_id", "n_words", "score") == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{small}/documents.parquet')")
    assert sorted(con.sql(Q.ORACLE["op2_lm_scoring"]).select("doc_id, n_words, score").fetchall(), key=repr) == want
