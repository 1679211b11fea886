import math

import numpy as np

from plinth.llm import mlm
from plinth.llm.catalog import op8_lm
from plinth.llm.common import Words
from tests.llm.conftest import LONG, frame


def brute(net, text):
    words = Words([text.encode()])
    ids = net.symbols(words.hash).tolist()
    total = 0.0
    for t, target in enumerate(ids):
        around = [ids[j] if 0 <= j < len(ids) else mlm.EDGE for j in (t - 2, t - 1, t + 1, t + 2)]
        h = np.tanh(sum(net.w["embed"][k][s].astype(float) for k, s in enumerate(around)))
        c, place = target % mlm.CLASSES, target // mlm.CLASSES
        for z, k in ((h @ net.w["out"] + net.w["out_bias"], c), (h @ net.w["word"][c] + net.w["word_bias"][c], place)):
            total += z[k] - math.log(np.exp(z).sum())
    return len(ids), total


def test_scores_match_brute_force(spark, documents):
    texts = [r.text for r in documents.limit(40).collect()] + [None, "", "one", LONG[:2000]]
    docs = frame(spark, texts).selectExpr("*", "1 AS n_words")
    net = mlm.fit(docs)
    rows = mlm.score(docs, net).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        n, total = brute(net, t or "")
        assert r.n_words == n and abs(r.log_likelihood - total) < 1e-3 * max(1, n)
        assert (r.mean_log is None) == (n == 0)
    assert mlm.score(frame(spark, []), mlm.fit(frame(spark, []))).count() == 0


def test_word_counts_cover_the_corpus(spark, documents):
    total = sum(len((r.text or "").encode().split()) for r in documents.collect())
    assert mlm.count_words(documents).agg({"n": "sum"}).first()[0] == total


def test_context_helps(spark):
    rng = np.random.default_rng(0)
    chain = [f"w{i}" for i in range(40)]
    texts = []
    for _ in range(3000):
        at = int(rng.integers(40))
        texts.append(" ".join(chain[(at + k) % 40] for k in range(30)))
    net = mlm.fit(frame(spark, texts))
    good = " ".join(chain[5:25])
    mixed = " ".join(rng.permutation(chain[5:25]))
    (_, (a, b)) = net.score([good.encode(), mixed.encode()])
    assert a / 20 > math.log(1 / 40) and a > b + 20


def test_query_covers_all_rows(spark):
    rows = op8_lm(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(r.log_likelihood <= 0 for r in rows)
