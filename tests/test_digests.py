"""D1-D3."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import CapturedException

from conftest import rows
from ripplekit.operators import digests

# Stored bcrypt strings of the reference's unit-test vectors
# (costs 6, 8, 10, 12), its client's cost-14 example and its malformed
# example.
VECTORS = [
    "$2a$06$DCq7YPn5Rq63x1Lad4cll.TV4S6ytwfsfvkgY8jIucDrjc8deX1s.",
    "$2a$08$HqWuK6/Ng6sg9gQzbLrgb.Tl.ZHfXLhvt/SgVyWhQqgqcZ7ZuUtye",
    "$2a$10$k1wbIrmNyFAPwPVPSVa/zecw2BCEnBwVS2GbrmgzxFUOqW9dk4TCW",
    "$2a$12$k42ZFHFWqBp3vWli.nIn8uYyIkbvYRvodzbfbK18SSsY.CsIQPlxO",
    "$2a$14$reBHJvwbb0UWqJHLyPTVF.6Ld5sFRirZx/bXMeMmeurJledKYdZmG",
    "too short",
]


def test_audit_vectors(spark):
    df = spark.createDataFrame([(h,) for h in VECTORS], "hash string")
    got = rows(digests.audit_hashes(df, "hash", min_cost=10, detail=True), "hash", "class", "cost")
    assert {h: (c, k) for h, c, k in got} == {
        VECTORS[0]: ("WEAK_COST", 6), VECTORS[1]: ("WEAK_COST", 8), VECTORS[2]: ("OK", 10),
        VECTORS[3]: ("OK", 12), VECTORS[4]: ("OK", 14), VECTORS[5]: ("BAD_VERSION", None)}


@pytest.mark.parametrize("h, cls", [
    ("$2b$10$" + "a" * 53, "BAD_REVISION"),
    ("$2a$1x$" + "a" * 53, "BAD_ROUNDS"),
    ("$2a$31$" + "a" * 53, "BAD_ROUNDS"),
    ("$2a$10!" + "a" * 53, "MISSING_ROUNDS"),
    ("$2a$10$" + "a" * 10, "BAD_SALT"),
    ("$2a$10$" + "a" * 21 + "*" + "a" * 31, "BAD_SALT"),
    ("$2a$10$" + "a" * 50, "BAD_LENGTH"),
    ("$2$10$" + "a" * 53, "OK"),
])
def test_audit_classes(spark, h, cls):
    df = spark.createDataFrame([(h,)], "hash string")
    assert [r["class"] for r in digests.audit_hashes(df, "hash", detail=True).collect()] == [cls]


def test_digest_roundtrip(spark):
    vals = spark.createDataFrame([(1, "a"), (2, "★★"), (3, "")], "id long, text string")
    # a random salt differs per evaluation: materialise the stored form once
    stored = spark.createDataFrame(digests.salted_digest(vals, "text").collect())
    assert all(r.digest.startswith("$s2$") for r in stored.collect())
    ok = digests.verify_digest(vals, stored, on="id", col="text")
    assert rows(ok) == [(1, True, False), (2, True, False), (3, True, False)]
    wrong = vals.withColumn("text", F.concat("text", F.lit("?")))
    assert [r.ok for r in digests.verify_digest(wrong, stored, on="id", col="text").collect()] \
        == [False] * 3


def test_malformed_digest(spark):
    vals = spark.createDataFrame([(1, "a")], "id long, text string")
    stored = spark.createDataFrame([(1, "too short")], "id long, digest string")
    assert rows(digests.verify_digest(vals, stored, on="id", col="text")) == [(1, None, True)]
    with pytest.raises(CapturedException):
        digests.verify_digest(vals, stored, on="id", col="text", on_malformed="error").collect()
