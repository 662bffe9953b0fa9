"""Fingerprints, search, packing, personal data and the pipeline."""

import hashlib
import os
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(__file__))))

from common_data import frame, odd_texts, rows  # noqa: E402

import corpus_pipeline  # noqa: E402
from ripplekit.llm import fingerprints as fp  # noqa: E402
from ripplekit.llm import packing, pii, simhash, topk  # noqa: E402
from ripplekit.llm import queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    import __spark_entry__ as entry
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in entry.queries()) == 1
    assert "pipeline" in entry.queries()


# -- fingerprints -------------------------------------------------------------------

@pytest.mark.parametrize("chars", [1, 200, 1 << 18])
def test_edited_texts(spark, chars, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_CHARS", chars)
    docs = [(i * 7, t) for i, t in odd_texts(8)]
    got = fp.edited_fingerprints(frame(spark, docs, "bucket")).collect()
    docs = sorted((i, t or "") for i, t in docs)
    nxt = docs[1:] + docs[:1]
    want = {}
    for (i, t), (_, u) in zip(docs, nxt):
        h = len(t) // 2
        want[i] = (len(t), hashlib.sha256((t[:len(t) - h] + u[:h]).encode()).hexdigest())
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    by = {r.doc_id: r for r in got}
    for (i, t), (j, _) in zip(docs, nxt):
        assert by[i].next_lanes == by[j].lanes


def test_multisets(spark):
    a, b = "one.\ntwo.\ntwo.", "three"
    texts = [(1, f"{a}\n{b}"), (2, f"two.\n{b}\none.\n\ntwo."), (3, a), (4, b), (5, "one.\ntwo.\n" + b), (6, "")]
    f = {r.doc_id: r for r in fp.fingerprints(frame(spark, texts).select("doc_id", "text"), ["doc_id"], "text").collect()}
    assert f[1].lanes == f[2].lanes != f[5].lanes
    assert set(f[6].lanes) == {0}
    d = spark.createDataFrame([(f[3].lanes, f[4].lanes, f[1].lanes)], "a array<long>, b array<long>, ab array<long>")
    r = d.select((fp.plus(F.col("a"), F.col("b")) == F.col("ab")).alias("p"),
                 (fp.minus(F.col("ab"), F.col("b")) == F.col("a")).alias("m")).first()
    assert r.p and r.m


def test_likeness_follows_the_shared_paragraphs(spark):
    rnd = random.Random(3)
    rows_ = []
    for shared in range(0, 41, 5):
        a = [str(rnd.random()) for _ in range(40)]
        rows_.append((shared, "\n".join(a), "\n".join(a[:shared] + [str(rnd.random()) for _ in range(40 - shared)])))
    d = spark.createDataFrame(rows_, "doc_id long, a string, b string")
    x = fp.fingerprints(d, ["doc_id"], "a").withColumnRenamed("lanes", "x")
    y = fp.fingerprints(d, ["doc_id"], "b").withColumnRenamed("lanes", "y")
    for r in x.join(y, "doc_id").select("doc_id", fp.likeness(F.col("x"), F.col("y")).alias("s")).collect():
        assert abs(r.s - r.doc_id / 40) < 0.4 and 0 <= r.s <= 1
        assert r.doc_id < 40 or r.s == 1


def test_fingerprints_of_extreme_ids_and_nothing(spark):
    big = 2**63 - 1
    got = fp.edited_fingerprints(frame(spark, [(-big, "ab"), (0, "cd"), (big, "ef")]))
    sha = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in ((-big, "ac"), (0, "ce"), (big, "ea"))}
    assert dict(rows(got, "doc_id", "edited_sha256")) == sha
    assert fp.edited_fingerprints(frame(spark, [])).count() == 0


def test_buckets_follow_the_ids(spark, monkeypatch):
    """One far id, or gaps, leave the buckets about equal."""
    monkeypatch.setattr(fp, "BUCKET_CHARS", 400)
    monkeypatch.setattr(fp, "SAMPLE_IDS", 300)
    ids = [*range(600), *range(10**6, 10**6 + 400), 2**62, -2**62]
    docs = spark.createDataFrame([(i, "some text " * 4) for i in ids], "doc_id long, text string")
    sizes = [r["count"] for r in fp.with_next(docs).where("guest = 0").groupBy("bucket").count().collect()]
    assert sum(sizes) == len(ids) and len(sizes) >= 50 and max(sizes) <= 5 * len(ids) / len(sizes)
    got = {r.doc_id: r for r in fp.with_next(docs).where("guest = 0").collect()}
    assert len(got) == len(ids) and all(r.next_text for r in got.values())


def test_fingerprint_query(spark):
    """The registered query against texts and fingerprints put together here."""
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    nxt = docs[1:] + docs[:1]
    edited = [(i, t[:len(t) - len(t) // 2] + u[:len(t) // 2]) for (i, t), (_, u) in zip(docs, nxt)]
    own, new = ({r.doc_id: r.lanes for r in fp.fingerprints(spark.createDataFrame(x, "doc_id long, text string"),
                                                            ["doc_id"], "text").collect()} for x in (docs, edited))
    hexed = lambda lanes: "".join(f"{x:08x}" for x in lanes)
    got = {r.doc_id: r for r in Q.op5_document_fingerprints(spark, SF).collect()}
    for (i, t), (j, u), (_, e) in zip(docs, nxt, edited):
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (hexed(own[i]), hexed(new[i]))
        assert 0 <= r.near_edited <= 1 and (r.near_next == 1) == (own[i] == own[j])
    assert len(got) == len(docs)


# -- search -------------------------------------------------------------------------

@pytest.mark.parametrize("block", [3, 8192])
def test_topk(spark, block, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(0)
    vecs = [(i, [float(x) for x in rng.integers(-3, 4, 6) / 64]) for i in range(50)]
    vecs += [(60, None), (61, [1.0, None]), (62, [float("nan")] * 6), (63, [float("inf")] * 6), (64, []),
             (65, [1.0, 2.0]), (66, [1e9] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in vecs], "vec_id long, embedding array<double>, score int")
    got = rows(topk.topk_search(df.where("vec_id % 5 = 0"), df, 7), "query_id", "rank", "vec_id", "score")
    ok = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in vecs
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, a in ok:
        if q % 5 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:7]
            want += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s)]
    assert got == sorted(want, key=repr)


def test_topk_of_repeated_queries(spark):
    """A query row that repeats is asked once; vectors that share an id are
    queries of their own."""
    vecs = spark.createDataFrame([(i, [float(i)]) for i in (1, 2, 3, 4)], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(9, [1.0]), (9, [1.0]), (9, [-1.0]), (None, [1.0])],
                                  "vec_id long, embedding array<double>")
    got = rows(topk.topk_search(asked, vecs, 3), "query_id", "rank", "vec_id", "score")
    up = [(9, 1, 4, 64 * 256), (9, 2, 3, 64 * 192), (9, 3, 2, 64 * 128)]
    down = [(9, 1, 1, -64 * 64), (9, 2, 2, -64 * 128), (9, 3, 3, -64 * 192)]
    assert got == sorted(up + down, key=repr)
    # repeated candidates count each
    got = rows(topk.topk_search(asked.limit(2), vecs.unionByName(vecs), 3), "query_id", "rank", "vec_id", "score")
    assert got == [(9, 1, 4, 64 * 256), (9, 2, 4, 64 * 256), (9, 3, 3, 64 * 192)]


def test_topk_query_and_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    rel = con.sql(Q.ORACLE["op6_exact_topk"]).select("query_id, rank, vec_id, score")
    assert rows(Q.op6_exact_topk(spark, SF), "query_id", "rank", "vec_id", "score") == \
        sorted(rel.fetchall(), key=repr)


def test_topk_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.topk_search(none, none).count() == 0


# -- packing ------------------------------------------------------------------------

def test_packing_round_trip(spark):
    docs = odd_texts(9) + [(1000, "word " * 9000), (1001, "It's  don't 123 x. y, z.. é. <|endoftext|> İ ΣΑΣ a.b"),
                         (1002, "J\u030c H\u0331. A\u0301 I\u0307 e\u0301. \u1e9e K\u212a"),
                         (1003, "\x1cA.\x1fb \u00a0c\u3000D. \x85 \x00x")]
    got = packing.pack(frame(spark, docs, "ids")).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in docs:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        mine = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        assert np.concatenate([np.frombuffer(r.ids, "<u2") for r in mine]).tolist() == ids
        at = 0
        for r in mine:
            assert r.start == at and r.doc_tokens == len(ids)
            part = np.array(ids[at:at + r.length], "<u4")
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for off, length in sorted(s):
            assert off == at
            at += length
        assert at <= 2048


def word_ids(tok, texts):
    data = [t.encode() for t in texts]
    buf = np.frombuffer(b"".join(data) + bytes(8), np.uint8)
    return [x.tolist() for x in tok(buf, np.concatenate([[0], np.cumsum([len(t) for t in data])]))]


def test_word_ids_are_the_tokenizers(monkeypatch):
    """On random strings of letters, marks, stops and white space, also when
    the memory of words is full again and again."""
    tok = packing.WordIds(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(12)
    alphabet = ["a", "b", "the", "ing", "Z", "É", "é", "ß", "İ", "Σ", "\u0301", "\u030c", ".", ",", "..", "'s", "'",
                "1", "٣", " ", "  ", "\n", "\t", "\x1f", "\u00a0", "-", "\x00", "日本", "\U0001F600", "x" * 30]
    for known in (600_000, 40, 0):
        monkeypatch.setattr(packing, "KNOWN_WORDS", known)
        for _ in range(40):
            texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(rnd.randint(1, 12))]
            assert word_ids(tok, texts) == [tok.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert word_ids(tok, [""]) == [[]]


def test_word_numbers():
    """The hash table against a dictionary, with equal keys of other words."""
    codes, want = packing._Codes(), {}
    rng = np.random.default_rng(5)
    for _ in range(30):
        keys = rng.integers(0, 1 << 63, 9000).astype(np.uint64) << np.uint64(14) | rng.integers(0, 9, 9000).astype(np.uint64)
        keys = np.unique(keys)
        keys = keys[[int(k) not in want for k in keys]]
        want |= dict(zip(keys.tolist(), codes.add(keys, keys + np.uint64(1)).tolist()))
    some = np.array(list(want), np.uint64)
    assert codes.find(some, some + np.uint64(1)).tolist() == list(want.values())
    assert (codes.find(some, some) == -1).all() and (codes.find(some ^ np.uint64(1 << 13), some) == -1).all()


def test_packing_query(spark):
    """The registered query: ids and lengths by the tokenizer, little padding."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = Q.op9_packing(spark, SF).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == {d.doc_id for d in docs}
    for d in docs:
        ids = np.array(tok.encode(d.text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[d.doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at:at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    sequences = len({r.sequence_id for r in got})
    assert sum(r.length for r in got) >= 0.97 * 2048 * (sequences - 1)


def test_best_fit_decreasing_is_the_plain_rule():
    rng = np.random.default_rng(1)
    for _ in range(50):
        w = int(rng.integers(1, 40))
        lengths = rng.integers(1, w + 1, int(rng.integers(0, 60)))
        seq, off = packing.best_fit_decreasing(lengths, w)
        rooms, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [r for r in rooms if r >= lengths[i]]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - lengths[i])
            else:
                rooms.append(w - lengths[i])
        got = [w] * (int(seq.max()) + 1 if len(seq) else 0)
        for i, s in enumerate(seq):
            got[s] -= lengths[i]
        assert sorted(got) == sorted(rooms)


def test_packing_of_nothing(spark):
    assert packing.pack(frame(spark, [])).count() == 0
    one = packing.pack(frame(spark, [(None, "a"), (1, None)])).collect()
    assert [(r.doc_id, r.length, r.doc_tokens) for r in one] == [(1, 1, 1)]


# -- personal data --------------------------------------------------------------------

RULES = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_base(text):
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            d = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                s = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d)))
                if not 12 <= len(d) <= 19 or s % 10:
                    continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans():
    rnd = random.Random(0)
    parts = ["a@b.c", "x.y%z@d-e.f.g", "@", "a@", "@b.c", "1.2.3.4", "300.1.1.1", "1.2.3.4.5", "4111 1111 1111 1111",
             "4111111111111112", "+1 (606) 555-7814", "+12", "12-34", ".", " ", "é", "-", "+", "0001.2.3.4", "7" * 20,
             "a@b@c.d", "+1 569 555 6633 4795326016703902", "٣"]
    for _ in range(3000):
        t = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 8)))
        assert pii.base_spans(t) == brute_base(t), t
    assert pii.base_spans("a" * 200000 + " x@y.z " + "9" * 200000) == [(200001, 0, 200006)]


def test_patterns_discover_what_the_rules_miss(spark):
    docs = [(i, f"Please reach me at +1 (606) 555-78{i:02d} today or so {i}") for i in range(20)]
    docs += [(100, "Please reach me at 6065557814 today"), (101, "order number 6065557814 shipped"),
             (102, "nothing to see here"), (103, None), (104, "the 12345 of the")]
    got = {r.doc_id: r for r in pii.find_pii(frame(spark, docs, "spans")).collect()}
    new = [(s["start"], pii.KINDS[s["kind"]], s["end"]) for s in got[100].spans]
    assert new == [(19, "phone", 29)] and got[100].base == []
    assert all(got[i].spans == [] for i in (101, 102, 103, 104))
    for i in range(20):
        assert [tuple(s) for s in got[i].base] == brute_base(docs[i][1]) and got[i].spans == got[i].base


def test_unknown_instances_weigh_less(spark):
    """Five seeds and two unknown numbers behind the same words: trusted; five
    seeds and twenty unknown ones: not."""
    docs = [(i, f"Call office line +1 (606) 555-78{i:02d} now") for i in range(6)]
    docs += [(10 + i, f"Call office line 60655578{i:02d}x now") for i in range(2)]
    docs += [(20 + i, f"See item code +1 (707) 555-78{i:02d} now") for i in range(6)]
    docs += [(30 + i, f"See item code 70755578{i:02d}y now") for i in range(20)]
    got = {r.doc_id: r for r in pii.find_pii(frame(spark, docs)).collect()}
    for i, text in docs:
        added = [(pii.KINDS[s["kind"]], text[s["start"]:s["end"]]) for s in got[i].spans[len(got[i].base):]]
        assert added == ([("phone", text.split()[3])] if 10 <= i < 20 else [])


def test_whole_identifiers_and_words_count():
    """Identifiers that share hundreds of characters are two, and the words
    before an identifier are found however long they are."""
    long = "k" * 300
    _, found = pii.mentions(f"{long}1@x.yz {long}2@x.yz and {'w' * 500} very{'w' * 200}: a@b.cd")
    insts = [f[3] for f in found]
    assert len(set(insts)) == 3 and all(len(x) < 100 for x in insts)
    pats = found[2][4]
    _, other = pii.mentions(f"{'w' * 501} very{'w' * 200}: a@b.cd")
    assert pats[0] != other[0][4][0] and pats[1] == other[0][4][1]
    _, near = pii.mentions("so call me: a@b.cd, x.y@b.cd")
    assert [f[4][0] for f in near] == ["w call me", "w b cd"]
    assert pii.mentions("a@b.cd")[1][0][4][0] == "w  "


def test_rows_that_share_an_id(spark):
    """Spans, groups and redacted texts go by id and text."""
    a, b = "mail a@b.cd now", "a long text before x.yz@mail.org and more"
    docs = [(7, a), (7, b), (7, b), (8, None), (8, "")]
    got = rows(pii.find_pii(frame(spark, docs)), "doc_id", "base")
    spans = {t: [(s, k, e) for s, k, e in brute_base(t or "")] for _, t in docs}
    assert sorted(map(str, ([tuple(s) for s in x] for _, x in got))) == sorted(str(spans[t]) for _, t in docs)
    out = rows(corpus_pipeline.redact_pii(spark, frame(spark, docs + [(None, a)]), SF), "doc_id", "text")
    assert out == sorted([(7, "mail [EMAIL] now"), (7, "a long text before [EMAIL] and more"),
                          (7, "a long text before [EMAIL] and more"), (8, None), (8, ""), (None, a)], key=repr)


def test_near_dedup_of_rows_that_share_an_id(spark):
    """One row per group, none of another group lost."""
    t = {x: " ".join(random.Random(x).choice("lmnopq") * 5 + str(random.Random(x * 7 + i).random()) for i in range(40))
         for x in range(5)}
    docs = [(3, t[0]), (7, t[0]), (7, t[1]), (9, t[2]), (9, t[2]), (11, t[3]), (11, t[3]), (12, t[3]), (13, t[4]),
            (None, t[0])]
    out = rows(corpus_pipeline.near_dedup(spark, frame(spark, docs, "often"), SF), "doc_id", "text")
    assert out == sorted([(3, t[0]), (7, t[1]), (9, t[2]), (11, t[3]), (13, t[4]), (None, t[0])], key=repr)
    # two texts of one id in one group: one of them stays
    near = t[0] + " x"
    out = corpus_pipeline.near_dedup(spark, frame(spark, [(5, t[0]), (5, t[0]), (5, near), (6, near), (6, t[1])]), SF)
    fps = rows(simhash.near_duplicates(frame(spark, [(1, t[0]), (2, near)])), "component_id")
    if fps == [(1,), (1,)]:
        got = rows(out, "doc_id", "text")
        assert len(got) == 2 and (6, t[1]) in got and got[0] in ((5, t[0]), (5, near))


def test_numbers_side_by_side(spark):
    docs = [(i, f"word{i} +1 (606) 555-78{i:02d} and thing {c}") for i, c in enumerate(
        ["4111111111111111", "5500000000000004", "4012888888881881", "5555555555554444", "4222222222222220",
         "5105105105105100", "4000056655665556", "5200828282828210", "4242424242424242", "6011111111111117"])]
    both = "x +1 (569) 555-6633 4795326016703902 y"
    got = {r.doc_id: r for r in pii.find_pii(frame(spark, docs + [(50, both), (51, "id 4795326016703903 7")])).collect()}
    assert got[50].base == [] and got[51].spans == []
    assert [(pii.KINDS[s["kind"]], both[s["start"]:s["end"]]) for s in got[50].spans] == [
        ("phone", "+1 (569) 555-6633"), ("card", "4795326016703902")]
    assert pii._redact(both, [dict(zip(("start", "kind", "end"), s)) for s in got[50].spans]) == "x [PHONE] [CARD] y"


def grouped_card(groups, seed):
    rnd = random.Random(seed)
    while True:
        c = " ".join("".join(rnd.choice("0123456789") for _ in range(n)) for n in groups)
        if pii._is_card(c):
            return c


def test_long_numbers_side_by_side(spark):
    cards = [grouped_card((4, 4, 4, 4), i) for i in range(60)]
    wide = [grouped_card((4, 4, 4, 4, 2), i) for i in range(60)]
    docs = [(100 + i, f"word {c} end") for i, c in enumerate(cards[4:] + wide[4:])]
    for i in range(10, 40):
        docs += [(200 + i, f"w{i} +33 6 12 34 {i} 78 x"), (300 + i, f"w{i} +1 415 555 {i} 71 x"),
                 (400 + i, f"w{i} +1 415 5{i} 26 x")]
    both = {50: ("+33 6 12 34 56 78", "4111 1111 1111 1111"), 51: ("+1 415 555 26 71", "4111 1111 1111 1111"),
            52: (cards[1], wide[2]), 53: (wide[0], wide[1])}
    docs += [(i, f"call {a} {b} now") for i, (a, b) in both.items()]
    got = {r.doc_id: r for r in pii.find_pii(frame(spark, docs)).collect()}
    for i, pair in both.items():
        text = dict(docs)[i]
        assert got[i].base == [] and tuple(text[s["start"]:s["end"]] for s in got[i].spans) == pair, i
        marks = ["[PHONE]" if x.startswith("+") else "[CARD]" for x in pair]
        assert pii._redact(text, [s.asDict() for s in got[i].spans]) == f"call {marks[0]} {marks[1]} now"


def test_parts_of_a_failed_match_are_all_tried():
    rnd = random.Random(2)
    parts = ["+1", "12", "4111", "1111", "4111-1111", "(415)", "-", "0", "555-26", "7" * 25, "71.", ".9"]
    for _ in range(500):
        text = " ".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        for kind, (rule, check) in pii._CHECKS.items():
            for m in rule.finditer(text):
                words = [(m.start() + w.start(), m.start() + w.end()) for w in re.finditer("[^ ]+", m.group())]
                want = {(s, k, e) for s, _ in words for _, e in words if s < e
                        for k, (r, c) in pii._CHECKS.items() if r.fullmatch(text, s, e) and c(text[s:e])}
                assert set(pii._inside(text, m.start(), m.end())) == want, text


def test_longest_parts_cover_all_that_parts_cover():
    assert pii.longest([(0, 3, 13), (0, 3, 16), (17, 2, 36)]) == [(0, 3, 16), (17, 2, 36)]
    assert pii.longest([(0, 3, 17), (0, 3, 22), (18, 2, 37)]) == [(0, 3, 17), (18, 2, 37)]
    assert pii.longest([(0, 2, 20), (15, 2, 34)]) == [(0, 2, 20), (15, 2, 34)]
    assert pii.longest([]) == []


def test_redaction_and_nothing(spark):
    assert pii._redact("mail a@b.c now", [{"start": 5, "kind": 0, "end": 10}]) == "mail [EMAIL] now"
    assert pii._redact("abcdef", [{"start": 1, "kind": 0, "end": 4}, {"start": 2, "kind": 1, "end": 5}]) == "a[EMAIL]f"
    assert pii.find_pii(frame(spark, [])).count() == 0


# -- queries and pipeline ----------------------------------------------------------------

def test_pii_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = dict(rows(spark.read.parquet(f"{sf}/documents.parquet"), "doc_id", "text"))
    for r in Q.op10_pii(spark, sf).collect():
        base = brute_base(texts[r.doc_id] or "")
        line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for _, k, _ in base) for x in range(4)]
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_pipeline_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").withColumn("node", F.lit(1))
    quality, dedup, redact, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    good = quality(spark, docs, sf).checkpoint()
    assert good.columns == docs.columns
    labels = dict(rows(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "quality"))
    kept = {r.doc_id for r in good.collect()}
    wrong = [i for i, q in labels.items() if (i in kept) != bool(q)]
    assert len(wrong) <= 0.05 * len(labels)
    one = dedup(spark, good, sf).checkpoint()
    fps = dict(rows(simhash.simhash(good), "doc_id", "fp"))
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(good).collect()}
    assert {r.doc_id for r in one.collect()} == set(groups.values()) and len(fps) == len(groups)
    clean = redact(spark, one, sf).checkpoint()
    assert clean.columns == docs.columns and clean.count() == one.count()
    before = dict(rows(one, "doc_id", "text"))
    for i, t in rows(clean, "doc_id", "text"):
        assert brute_base(t) == [] or "[" in t
        assert t == before[i] or "[" in t
    mixed = mix(spark, clean, sf).checkpoint()
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} <= set(before)
    packed = pack(spark, mixed, sf)
    tokens = packed.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert packed.agg(F.sum("length")).first()[0] == tokens


def test_pipeline_of_nothing(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").where("doc_id is null")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf).checkpoint()
        assert docs.count() == 0


def test_pipeline_of_odd_rows(spark):
    sf = "/root/testdata/sf0.001"
    docs = frame(spark, odd_texts(11) + [(None, "no id"), (7, "same"), (7, "same")], "spans")
    quality, dedup, redact, mix, pack = (f for _, f in corpus_pipeline.STAGES)
    out = redact(spark, dedup(spark, docs, sf), sf)
    assert out.columns == docs.columns and out.where("doc_id is null").count() == 1
    assert pack(spark, mix(spark, out, sf), sf).count() > 0
