"""Divergence audit against plain counts."""

import os
import random
import re
import sys
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from common_data import odd_texts  # noqa: E402
from ripplekit.llm import divergence  # noqa: E402
from ripplekit.llm.queries import ORACLE, op11_source_divergence  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "text string, lang string, source string, term string, n long, value string"


def brute_force(rows, least, top):
    docs, counts, groups = Counter(), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts[lang, source].update(terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang, source in groups:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]
        share = lambda of: {t: 1 + 10**9 * (n + 2) // (sum(of.values()) + 2 * len(kept))
                            for t, n in of.items()}
        of = lambda s: {t: counts[lang, s][t] for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        p = share(of(source))
        all_of = {t: sum(counts[g][t] for g in groups if g[0] == lang) for t in kept}
        q = share(all_of)
        pairs = [(sum(f(p[t], r[t]) for t in kept), s) for x, s in groups if x == lang and s != source
                 for r in [share(of(s))]]
        terms = [(f(p[t], q[t]), t) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            items.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(items[:most])]
    return sorted(out)


def result(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("entries", [1, 7, 1 << 18])
def test_audit(spark, entries):
    """Nulls, empty and long texts, repeated rows, a hot source, ties, in
    blocks of any size."""
    rnd = random.Random(entries)
    rows = [(t, rnd.choice(["en", "de", None]), rnd.choice(["hot"] * 3 + ["b", "ü", None, ""]))
            for _, t in odd_texts(entries) + odd_texts(9)]
    rows += rows[:9] + [(None, "xx", "a"), ("", "xx", "b"), ("rare words", "xx", "c"), (None, None, None)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    for least in (1, 4):
        assert result(divergence.audit(df, least, 3, entries)) == brute_force(rows, least, 3)


def test_empty(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_counts_stay_exact():
    n = np.array([0, 1, 10**15 // 3, 2 * 10**15], np.int64)
    got = divergence.share(n, 4 * 10**15, 12345)
    assert got.tolist() == [1 + 10**9 * (int(x) + 2) // (4 * 10**15 + 24690) for x in n]


def test_query_and_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(ORACLE["op11_source_divergence"])
    assert want.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = result(op11_source_divergence(spark, SF))
    assert got == sorted(want.fetchall())
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("text", "lang", "source").collect()]
    assert got == brute_force(rows, 10, 10)
