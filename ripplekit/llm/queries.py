"""The registered queries of the ``llm`` operators, one per operator, over
whole tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplekit.llm import (divergence, fingerprints, licenses, lm_scoring, mixing, packing, pii, prefix_trie, quality,
                           simhash, substring_dedup, suffix_dedup, topk)
from ripplekit.sources.tables import table


def _sha(col: str) -> F.Column:
    return F.sha2(F.encode(col, "UTF-8"), 256)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), n=13)
    return out.select("doc_id", "n_words", "n_removed", _sha("kept_text").alias("kept_sha256"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(table(spark, sf_dir, "documents"), vocabulary_size=None).select("doc_id", "n_words", "score")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), length=400)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.with_quality(docs.select("doc_id", "text"), model).select(
        "doc_id", quality.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))
    return f.select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprints.to_hex(F.col("lanes")).alias("fingerprint"),
        fingerprints.to_hex(F.col("edited_lanes")).alias("edited_fingerprint"),
        fingerprints.likeness(F.col("lanes"), F.col("edited_lanes")).alias("near_edited"),
        fingerprints.likeness(F.col("lanes"), F.col("next_lanes")).alias("near_next"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.topk_search(vectors.where(F.col("vec_id") % 20 == 0), vectors, k=20)


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=2)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Token shares that the mix aims at, by the language that the labelled
# documents are marked with.
MIX = {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1}


def mix_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, label``: the language of the documents in the labelled table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    return table(spark, sf_dir, "labels").select("doc_id").join(docs, "doc_id")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, fitted, scored = mixing.mix(docs, mix_labels(spark, sf_dir), MIX)
    return mixing.rated(scored, fitted).select(
        "doc_id", "tokens", *[F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(model.classes)],
        "rate", "copies")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *[pii.count_of(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
                      F.sha2(F.encode(pii.spans_text(F.col("base")), "UTF-8"), 256).alias("base_sha256"),
                      pii.spans_text(F.col("spans")).alias("spans"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, spans = F.col("base"), F.col("spans")
    first = F.transform(base, lambda b: b["first_word"])
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        licenses.labels_text(base).alias("base_labels"), licenses.labels_text(base, spans).alias("labels"), "score")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_lm_scoring, op3_suffix_dedup, op4_quality_classifier, op5_document_fingerprints,
    op6_exact_topk, op7_simhash_near_dedup, op8_mixing, op9_packing, op10_pii, op11_source_divergence,
    op12_license_scan, op13_prefix_trie)}

ORACLE = {
    "op1_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM words)),
least_doc AS (SELECT k, min(doc_id) AS m FROM wins GROUP BY k),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps
  FROM (SELECT w.doc_id, unnest(range(w.i, w.i + 13)) AS p
        FROM wins w JOIN least_doc l USING (k) WHERE w.doc_id > l.m)
  GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN ps IS NULL THEN array_to_string(ws, ' ')
    ELSE coalesce(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(ps, i)), ' '), '') END) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)""",
    "op2_lm_scoring": r"""
WITH t AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents)),
total AS (SELECT count(*) AS n FROM t),
own1 AS (SELECT doc_id, w, count(*) AS o FROM t GROUP BY ALL),
c1 AS (SELECT w, sum(o) AS c FROM own1 GROUP BY w),
len AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
uni AS (
  SELECT doc_id, w, c - o AS rest,
    round(1e6 * ln(greatest(c - o, 1)))::BIGINT
      - round(1e6 * ln(greatest((SELECT n FROM total) - len.n, 1)))::BIGINT AS u
  FROM own1 JOIN c1 USING (w) JOIN len USING (doc_id)),
own2 AS (
  SELECT a.doc_id, a.w AS v, b.w, count(*) AS o
  FROM t a JOIN t b ON a.doc_id = b.doc_id AND b.i = a.i + 1 GROUP BY ALL),
c2 AS (SELECT v, w, sum(o) AS c FROM own2 GROUP BY ALL),
terms AS (
  SELECT own2.doc_id, own2.o * CASE WHEN c2.c > own2.o
      THEN round(1e6 * ln(c2.c - own2.o))::BIGINT - round(1e6 * ln(greatest(x.rest, 1)))::BIGINT
      ELSE round(1e6 * ln(0.4))::BIGINT + y.u END AS s
  FROM own2 JOIN c2 USING (v, w)
  JOIN uni x ON x.doc_id = own2.doc_id AND x.w = own2.v
  JOIN uni y ON y.doc_id = own2.doc_id AND y.w = own2.w
  UNION ALL
  SELECT t.doc_id, u AS s FROM t JOIN uni USING (doc_id, w) WHERE i = 0)
SELECT d.doc_id, coalesce(any_value(len.n), 0)::BIGINT AS n_words, coalesce(sum(s), 0)::BIGINT AS score
FROM documents d LEFT JOIN terms USING (doc_id) LEFT JOIN len USING (doc_id)
GROUP BY d.doc_id""",
    "op6_exact_topk": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_source_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT lang, source, r, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS k FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
size AS (SELECT lang, sum(k)::HUGEINT AS total, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
total AS (SELECT lang, source, sum(n)::HUGEINT AS total FROM c GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, term, coalesce(c.n, 0) AS n,
    1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 2) // (coalesce(total.total, 0) + 2 * size.v) AS p,
    1 + 1000000000::HUGEINT * (kept.k + 2) // (size.total + 2 * size.v) AS q
  FROM g JOIN kept USING (lang) JOIN size USING (lang) LEFT JOIN c USING (lang, source, term)
  LEFT JOIN total USING (lang, source)),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, rank::INT AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM (FROM pairs UNION ALL FROM terms))
WHERE part = 'pair' OR rank <= 10""",
    "op13_prefix_trie": r"""
WITH own AS (
  SELECT c, k, chars, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, k) AS pos
  FROM (SELECT conv_id AS c, turn, coalesce(role, '') AS role, length(coalesce(text, '')) AS chars,
          md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k
        FROM conversations WHERE conv_id IS NOT NULL)),
-- CRC-32, bit by bit, of the decimal id
convs AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce(
      list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0::UBIGINT for i in range(8)]),
        lambda x, y: CASE WHEN x & 1::UBIGINT = 1 THEN xor(x >> 1::UBIGINT, 3988292384::UBIGINT)
                          ELSE x >> 1::UBIGINT END)), 4294967295::UBIGINT) % 6 AS h
  FROM (SELECT DISTINCT c FROM own)),
rebuilt AS (
  SELECT convs.c, pos AS d, k, chars FROM convs JOIN own ON own.c = convs.base AND pos <= h
  UNION ALL
  SELECT convs.c, pos - h + least(h, (SELECT count(*) FROM own o WHERE o.c = convs.base)) AS d, k, chars
  FROM convs JOIN own ON own.c = convs.c AND pos > h),
rows AS (
  SELECT c, d, chars, string_agg(k, '') OVER (PARTITION BY c ORDER BY d) AS path FROM rebuilt
  UNION ALL SELECT c, 0, 0, '' FROM convs),
nodes AS (
  SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM rows GROUP BY d, path),
ends AS (
  SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS sha
  FROM (SELECT c, arg_max(path, d) AS path FROM rows GROUP BY c) GROUP BY path),
children AS (
  SELECT path[:-33] AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
below AS (
  SELECT r.path, count(*) FILTER (WHERE ch.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM nodes n LEFT JOIN children ch ON ch.path = n.path JOIN rows r ON r.c = n.conv_id AND r.d <= n.d
  GROUP BY r.path)
SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(ch.n, 0)::BIGINT AS n_children, b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens,
  coalesce(e.sha, sha256('')) AS ends_sha256
FROM nodes n JOIN below b USING (path) LEFT JOIN children ch ON ch.path = n.path
LEFT JOIN nodes up ON up.path = n.path[:-33] AND up.d = n.d - 1 LEFT JOIN ends e ON e.path = n.path""",
}
