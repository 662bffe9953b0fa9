"""Salted digests and stored-hash audits as column jobs.

The original service hashes one password per call with a slow, salted,
self-describing scheme.  Here the same shape is applied to whole columns:
a salted SHA-256 digest in a self-describing text form (``$s2$<salt>$<hex>``)
for pseudonymising a column, its verification, and an audit of stored
bcrypt-format strings.  The digest is *not* a password hash: it has no work
factor.  Everything is built-in Spark SQL functions (JVM, codegen).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGEST_PREFIX = "$s2$"
_DIGEST_RX = r"^\$s2\$([0-9a-f]+)\$([0-9a-f]{64})$"


def digest_expr(value: Column, salt: Column) -> Column:
    return F.concat(F.lit(DIGEST_PREFIX), salt, F.lit("$"),
                    F.sha2(F.concat(salt, value), 256))


def random_salt() -> Column:
    """32 hex characters from a random UUID per row (non-deterministic: write
    the result before reading it twice)."""
    return F.regexp_replace(F.expr("uuid()"), "-", "")


def salted_digest(df: DataFrame, col: str, salt: Column | None = None,
                  out: str = "digest") -> DataFrame:
    """Add ``out`` = ``$s2$<salt>$<sha256(salt || value)>`` for every row.
    ``salt`` must be lowercase hex; by default a random one per row."""
    salt = random_salt() if salt is None else salt
    # The salt is a column of its own so a random salt is drawn once per row
    # and used both in the text form and in the hashed input.
    return (df.withColumn("_salt", salt)
            .withColumn(out, digest_expr(F.col(col), F.col("_salt"))).drop("_salt"))


def verify_digest(values: DataFrame, stored: DataFrame, on: str, col: str,
                  digest: str = "digest", on_malformed: str = "flag") -> DataFrame:
    """``on, ok boolean, malformed boolean`` per stored row joined to
    its value by ``on``.  A malformed stored form raises
    (``on_malformed='error'``) or gives ``ok`` null (``'flag'``)."""
    j = stored.select(on, digest).join(values.select(on, col), on=on, how="left")
    d = F.col(digest)
    good = d.rlike(_DIGEST_RX)
    salt = F.regexp_extract(d, _DIGEST_RX, 1)
    want = F.regexp_extract(d, _DIGEST_RX, 2)
    ok = F.sha2(F.concat(salt, F.col(col)), 256) == want
    if on_malformed == "error":
        ok = F.when(good, ok).otherwise(
            F.raise_error(F.concat(F.lit("malformed digest: "), F.coalesce(d, F.lit("null")))))
        return j.select(on, ok.alias("ok"), F.lit(False).alias("malformed"))
    return j.select(on, F.when(good, ok).alias("ok"), (~good).alias("malformed"))


# Fixed values of the bcrypt text format: version marker, the accepted
# revision, the range of the cost field, salt length in characters, the
# salt alphabet, and full lengths with and without a revision letter.
BCRYPT_VERSION = "$2"
BCRYPT_REVISION = "a"
BCRYPT_MIN_ROUNDS = 4
BCRYPT_MAX_ROUNDS = 30
BCRYPT_SALT_CHARS = 22
BCRYPT_ALPHABET = "./ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
BCRYPT_LEN_WITH_REVISION = 60
BCRYPT_LEN_WITHOUT_REVISION = 59


def audit_class(h: Column, min_cost: int) -> tuple[Column, Column]:
    """Error class and cost of a stored bcrypt string, checked in the order
    the format is parsed: version, revision, rounds terminator, rounds,
    salt, total length, then the wanted minimum cost."""
    has_rev = F.substring(h, 3, 1) != "$"
    off = F.when(has_rev, F.lit(4)).otherwise(F.lit(3))      # 0-based offset of rounds
    rev_ok = ~has_rev | ((F.substring(h, 3, 1) == BCRYPT_REVISION) & (F.substring(h, 4, 1) == "$"))
    rounds_txt = F.substring(h, off + 1, 2)
    term = F.substring(h, off + 3, 1)
    rounds = F.when(rounds_txt.rlike("^[0-9]{2}$"), rounds_txt.cast("int"))
    salt = F.substring(h, off + 4, BCRYPT_SALT_CHARS)
    alphabet_rx = "^[" + BCRYPT_ALPHABET.replace(".", "\\.") + "]{" + str(BCRYPT_SALT_CHARS) + "}$"
    full_len = F.when(has_rev, F.lit(BCRYPT_LEN_WITH_REVISION)).otherwise(
        F.lit(BCRYPT_LEN_WITHOUT_REVISION))
    cls = (F.when(~h.startswith(BCRYPT_VERSION), F.lit("BAD_VERSION"))
           .when(~rev_ok, F.lit("BAD_REVISION"))
           .when(term != "$", F.lit("MISSING_ROUNDS"))
           .when(rounds.isNull() | (rounds < BCRYPT_MIN_ROUNDS) | (rounds > BCRYPT_MAX_ROUNDS),
                 F.lit("BAD_ROUNDS"))
           .when(~salt.rlike(alphabet_rx), F.lit("BAD_SALT"))
           .when(F.length(h) != full_len, F.lit("BAD_LENGTH"))
           .when(rounds < min_cost, F.lit("WEAK_COST"))
           .otherwise(F.lit("OK")))
    cost = F.when(cls.isin("BAD_VERSION", "BAD_REVISION", "MISSING_ROUNDS"),
                  F.lit(None).cast("int")).otherwise(rounds)
    return cls, cost


def audit_hashes(df: DataFrame, col: str, min_cost: int = 10, detail: bool = False) -> DataFrame:
    """D3: ``class, cost, n`` counts of stored hashes per error class and
    cost (``detail=True``: the per-row classes instead)."""
    cls, cost = audit_class(F.col(col), min_cost)
    rows = df.select("*", cls.alias("class"), cost.alias("cost"))
    if detail:
        return rows
    return rows.groupBy("class", "cost").agg(F.count(F.lit(1)).alias("n"))
