import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from plinth.llm import resample
from plinth.llm.catalog import op13_resample
from tests.llm.conftest import LONG, frame

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def buckets(text):
    w = _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def expected(texts, target, percent=5, least=20):
    """doc_id -> (n_features, weight, score, rank), all rows sorted."""
    docs = {k: buckets(t) for k, t in texts.items()}
    s, t = Counter(b for _, f in docs.values() for b in f), Counter(b for x in target for b in buckets(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in s}
    rows = {}
    for k, (n, f) in docs.items():
        weight, h = sum(gain[b] for b in f), int(hashlib.sha256(f"42:{k}".encode()).hexdigest()[:8], 16)
        rows[k] = (n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))))
    able = sorted((k for k in rows if rows[k][0] >= least), key=lambda k: (-rows[k][3], k))
    rank = {k: i for i, k in enumerate(able[:percent * len(able) // 100], 1)}
    return {k: (*r[1:], rank.get(k)) for k, r in rows.items()}


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    target = [r.text for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    rows = {r.doc_id: tuple(r)[1:] for r in op13_resample(spark, d).collect()}
    assert rows == expected(texts, target) and sum(r[3] is not None for r in rows.values()) > 30


def test_edge_rows(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["aa", "Bb", "ç", "1", "long" * 30, "x" * 49], k=rng.randint(0, 60))) for _ in range(120)]
    texts += [None, "", "one", "one two", "?!", LONG, *texts[:30]]
    target = ["aa bb ç", None, "1 1 1 1", ""]
    docs = frame(spark, texts).selectExpr("*", "'q' AS weight", "0 AS rank")
    items = frame(spark, target)
    got = resample.resample(docs, items, percent=30)
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()} == expected(
        dict(enumerate(texts)), target, percent=30)
    assert {r.doc_id: r.text for r in got.collect()} == dict(enumerate(texts))
    assert resample.resample(frame(spark, []), items).count() == 0
    none = resample.resample(docs, items.limit(0), percent=1, min_words=10 ** 9).collect()
    assert len(none) == len(texts) and all(r["rank"] is None for r in none)
    assert resample.resample(docs, items, percent=100, min_words=0).filter("rank IS NULL").count() == 0


def test_repeated_rows_and_ids_are_drawn_one_by_one(spark):
    text = "w " * 25
    docs = frame(spark, [text] * 40, [None] * 10 + [5] * 20 + list(range(10)))
    rows = resample.resample(docs, docs, percent=50).collect()
    assert len(rows) == 40 and sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 21))
    key = [(-r.score, r.doc_id is None, r.doc_id or 0) for r in rows if r["rank"]]
    assert max(key) <= min((-r.score, r.doc_id is None, r.doc_id or 0) for r in rows if not r["rank"])
    names = docs.selectExpr("CAST(doc_id AS STRING) AS doc_id", "text")
    assert resample.resample(names, names, percent=50).filter("rank IS NOT NULL").count() == 20


@pytest.mark.parametrize("n", [1, 15, 16, 500])
def test_quickselect_finds_each_key(spark, n):
    rng = random.Random(n)
    rows = [(rng.randint(-3, 3), rng.randint(0, 4) * 0.5, i) for i in range(n)]
    keys = spark.createDataFrame(rows, "a long, b double, c long").repartition(5).cache()
    for k in sorted({1, n, (n + 1) // 2, max(1, n // 3)}):
        assert resample.kth_key(keys, k, seed=k) == sorted(rows)[k - 1]
    with pytest.raises(ValueError, match="fewer"):
        resample.kth_key(keys, n + 1)


def test_long_texts_are_hashed_in_blocks(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["a", "bc", "def", "g" * 60, "é"], k=300)).encode() + b"..", b"x" * 500, b"?" * 500, b"a " * 300]
    monkeypatch.setattr(resample, "JOIN_BYTES", 100)
    for t in texts:
        found, words = Counter(), 0
        for _, n, _, b in resample.features([t]):
            found.update(b.tolist())
            words += int(n[0])
        want = buckets(t.decode())
        assert words == want[0] and found == Counter(want[1])


def test_gains_follow_the_counts():
    s, t = np.zeros(resample.BUCKETS, np.int64), np.zeros(resample.BUCKETS, np.int64)
    s[:3], t[:3] = (10, 0, 5), (0, 10, 5)
    g = resample.gains(s, t)
    assert g[0] < g[2] <= g[1] and g[3] == math.floor(1000 * math.log(10015 / 10015)) and g[1] > 0
