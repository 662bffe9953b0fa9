"""Document fingerprints: a homomorphic multiset hash of paragraphs.

Every paragraph is hashed to a wide vector of ``LANES`` small signed values;
a document's fingerprint is the sum of its paragraphs' vectors, each lane
modulo 2^32.  Order does not matter, equal multisets give equal fingerprints,
and a paragraph is added or taken away by adding or subtracting its vector
(:func:`plus`, :func:`minus`).  As the vectors of different paragraphs are
nearly orthogonal, the inner product of two fingerprints estimates how many
paragraphs they share, which :func:`likeness` turns into a value of 0 to 1.

A paragraph is a line; a line is cut further behind ``.``, ``!`` or ``?``
followed by a space, so that a document of one line still has parts.  Empty
paragraphs do not count.  Everything here is DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 64                # 16-bit values of a paragraph's vector: 1,024 bits
_PER_HASH = 4
_MOD = 1 << 32
BUCKET_CHARS = 1 << 18    # characters of text in a bucket of neighbours, on average
MOST_BUCKETS = 1 << 17    # beyond these buckets grow with the corpus
SAMPLE_IDS = 1 << 20      # ids that the buckets' bounds are taken from, about


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, r"\n|(?<=[.!?]) "), lambda p: p != "")


def _lane_sums(par: Column) -> list[Column]:
    """Sum over paragraphs of every lane (modulo 2^32): four signed 16-bit
    values from each of ``LANES / 4`` hashes with salts of their own."""
    out = []
    for k in range(LANES // _PER_HASH):
        h = F.xxhash64(F.lit(k), par)
        for j in range(_PER_HASH):
            lane = F.shiftrightunsigned(h, 16 * j).bitwiseAND(F.lit(0xFFFF)) - F.lit(0x8000)
            # null (no paragraph) adds nothing
            out.append(F.pmod(F.coalesce(F.sum(F.when(par.isNotNull(), lane)), F.lit(0)), F.lit(_MOD)))
    return out


def to_hex(lanes: Column) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def plus(a: Column, b: Column) -> Column:
    """Fingerprint (lane array) of the union of two multisets."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + y, F.lit(_MOD)))


def minus(a: Column, b: Column) -> Column:
    """Fingerprint (lane array) after the paragraphs of ``b`` leave ``a``."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x - y, F.lit(_MOD)))


def likeness(a: Column, b: Column) -> Column:
    """2<a,b> / (<a,a> + <b,b>), cut to 0..1, on the lanes as signed values;
    equal fingerprints give 1."""
    def signed(x):
        return F.when(x >= _MOD // 2, x - _MOD).otherwise(x).cast("double")

    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: signed(p) * signed(q)), F.lit(0.0),
                           lambda acc, v: acc + v)

    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(F.greatest(F.lit(0.0), F.least(
        F.lit(1.0), F.try_divide(2 * dot(a, b), dot(a, a) + dot(b, b)))), F.lit(0.0)))


def fingerprints(texts: DataFrame, keys: list[str], text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keys, keep, lanes array<long>``: one fingerprint per value of
    ``keys``.  The paragraphs are summed in the task that cuts them."""
    par = texts.select(*keys, *keep, F.explode_outer(paragraphs(F.col(text_col))).alias("_par"))
    sums = _lane_sums(F.col("_par"))
    agg = par.groupBy(*keys).agg(*[F.first(c).alias(c) for c in keep],
                                 *[s.alias(f"_l{i}") for i, s in enumerate(sums)])
    return agg.select(*keys, *keep, F.array(*[f"_l{i}" for i in range(LANES)]).alias("lanes"))


def _bounds(docs: DataFrame, chars: int) -> list[int]:
    """Ids that part the documents into buckets of about equal numbers, from
    the ids of at most about ``SAMPLE_IDS`` rows picked by a hash; any bounds
    give the same result."""
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    buckets = min(MOST_BUCKETS, -(-(size["chars"] or 0) // chars), size["n"])
    if buckets < 2:
        return []
    every = max(1, size["n"] // SAMPLE_IDS)
    shares = F.split(F.lit(",".join(str(k / buckets) for k in range(1, buckets))), ",").cast("array<double>")
    picked = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    found = picked.agg(F.percentile_approx("doc_id", shares, F.lit(10 * buckets)).alias("b")).first()["b"]
    return sorted(set(found or []))


def _bucket(bounds: list[int]) -> Column:
    """How many bounds are not above ``doc_id``, by halving steps."""
    if not bounds:
        return F.lit(0)
    at = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda n, step: F.when(
        (n + step <= len(bounds)) & (F.try_element_at(at, n + step) <= F.col("doc_id")), n + step).otherwise(n))


def with_next(docs: DataFrame) -> DataFrame:
    """``bucket, guest, rank, doc_id, text, next_text`` with the text of the
    next document by ascending ``doc_id`` (after the last: the first).

    Documents are dealt into buckets of neighbours by bounds taken from the
    ids themselves, at most ``MOST_BUCKETS``, whatever gaps the ids have.  A
    window runs within each bucket; the first document of a bucket is also put
    behind the last of the bucket before, as its ``guest`` (without a next
    text).  Only the first id of each bucket is broadcast."""
    d = docs.withColumn("bucket", _bucket(_bounds(docs, BUCKET_CHARS)))
    firsts = d.groupBy("bucket").agg(F.min("doc_id").alias("first"))
    by = Window.orderBy("bucket")
    edge = firsts.select(
        "first", F.coalesce(F.lag("bucket").over(by),
                            F.max("bucket").over(by.rowsBetween(Window.unboundedPreceding,
                                                                Window.unboundedFollowing))).alias("before"))
    placed = d.select("bucket", F.lit(0).alias("guest"), "doc_id", "text")
    # A guest sorts behind all documents of the bucket that it visits.
    guests = docs.join(F.broadcast(edge), docs["doc_id"] == edge["first"]).select(
        F.col("before").alias("bucket"), F.lit(1).alias("guest"), "doc_id", "text")
    # Rows that share the first id: only one of them is the guest.
    guests = guests.groupBy("bucket", "guest", "doc_id").agg(F.min("text").alias("text"))
    near = Window.partitionBy("bucket").orderBy("guest", "doc_id", "text")
    return placed.unionByName(guests).select(
        "bucket", "guest", "doc_id", "text", F.row_number().over(near).alias("rank"),
        F.when(F.col("guest") == 0, F.lead("text").over(near)).alias("next_text"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, lanes, edited_lanes, next_lanes``.

    The edited text is the text with its last floor(n/2) code points replaced
    by the first as many (or all) of the next document.  A null text is
    empty; rows without an id are left out; rows that share an id follow one
    another by text; other columns are not read.  Every text is hashed once:
    the next document's fingerprint is taken from its own row (or that of the
    guest)."""
    d = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    keys = ["bucket", "rank", "guest", "doc_id"]
    t = with_next(d).select(
        *keys, "text", n.cast("long").alias("n_chars"),
        F.concat(F.substring("text", F.lit(1), n - half),
                 F.substring("next_text", F.lit(1), half)).alias("edited"))
    own = F.struct(F.lit(0).alias("kind"), F.col("text").alias("text"))
    edited = F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text"))
    t = t.select(*keys, "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                 F.explode(F.when(F.col("guest") == 0, F.array(own, edited)).otherwise(F.array(own))).alias("v"))
    f = fingerprints(t.select(*keys, "n_chars", "edited_sha256", "v.kind", "v.text"),
                     [*keys, "kind"], "text", keep=("n_chars", "edited_sha256"))
    lanes = [F.max(F.when(F.col("kind") == k, F.col("lanes"))).alias(name)
             for k, name in enumerate(("lanes", "edited_lanes"))]
    f = f.groupBy(*keys).agg(F.first("n_chars").alias("n_chars"),
                             F.first("edited_sha256").alias("edited_sha256"), *lanes)
    near = Window.partitionBy("bucket").orderBy("rank")
    return f.withColumn("next_lanes", F.lead("lanes").over(near)).where("guest = 0").drop("bucket", "rank", "guest")
