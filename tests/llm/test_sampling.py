from pyspark.sql import functions as F

from plinth.llm import langid
from plinth.llm.common import in_share


def test_share_of_a_hash_holds_at_any_size(spark):
    rows = spark.range(400_000).select(F.xxhash64("id").alias("h"))
    for share in (1.0, 0.5, 0.01, 1e-4):
        n = rows.filter(in_share(F.col("h"), share)).count()
        assert abs(n - share * 400_000) <= 6 * (share * (1 - share) * 400_000) ** 0.5
    for share in (800 / 10**12, 1e-15):                                   # rows claimed: far more than can be made here
        edge = int(share * 2.0**64) - 2**63
        low = spark.createDataFrame([(edge - 1,), (edge,), (-(2**63),), (2**63 - 1,)], "h long")
        assert [r[0] for r in low.filter(in_share(F.col("h"), share)).collect()] == [edge - 1, -(2**63)]


def test_language_sample_keeps_its_size(spark, monkeypatch):
    """The sample of a language does not vanish when its rows are claimed to be a trillion."""
    made = spark.range(3000).selectExpr("id AS doc_id", "concat('text number ', id) AS text", "'en' AS lang")
    asked = []
    monkeypatch.setattr(langid, "in_share", lambda hashed, share: asked.append(share) or in_share(hashed, share))
    rows = langid.sample(made, "text", "lang", "doc_id", 300)
    assert 200 < len(rows) < 400 and asked == [0.1]
    assert round(in_share_size(10**12, 800 / 10**12)) == 800


def in_share_size(n, share):
    """Rows expected of n hashes spread evenly over 64 bits."""
    return n * int(share * 2.0**64) / 2**64
