"""Words beyond the network's symbols: probabilities of their own, and of their spelling when unseen."""
import math
from collections import Counter

import numpy as np

from plinth.llm import mlm
from plinth.llm.common import Words
from tests.llm.conftest import LONG, frame


def _corpus():
    rng = np.random.default_rng(5)
    rare = ["".join(rng.choice(list("abcdeno"), 7)) for _ in range(1500)]
    texts = [" ".join(f"w{i}" for i in rng.permutation(2100)) for _ in range(20)]
    return texts + [" ".join(rare[k::50] * (1 + k % 3)) for k in range(50)], rare


def test_every_word_has_its_probability(spark):
    texts, rare = _corpus()
    texts += [None, "", texts[30], LONG[:500]]
    docs = frame(spark, texts)
    counts = mlm.count_words(docs)
    net = mlm.fit(docs, counts=counts)
    rows = mlm.score_words(docs, net, counts).orderBy("doc_id").collect()
    plain = mlm.score(docs, net).orderBy("doc_id").collect()
    times = Counter(w for t in texts for w in (t or "").encode().lower().split())
    known = set(net.words.tolist())
    tail = {w: n for w, n in times.items() if int(Words([w]).hash[0]) not in known}
    spell = Counter(p for w, n in tail.items() for p in zip(b" " + w, w + b" ") for _ in range(n))
    before = Counter(p for w, n in tail.items() for p in b" " + w for _ in range(n))
    assert len(tail) > 1000 and net.pairs.sum() == sum(spell.values())
    for r, p, t in zip(rows, plain, texts, strict=True):
        want = p.log_likelihood
        for w in (t or "").encode().lower().split():
            if w in tail:
                chars = math.prod((spell[x] + 1 / 256) / (before[x[0]] + 1) for x in zip(b" " + w, w + b" "))
                want += math.log((tail[w] + len(tail) * chars) / (sum(tail.values()) + len(tail)))
        assert r.n_words == p.n_words and abs(r.log_likelihood - want) < 1e-4 * max(1, r.n_words)
        assert (r.mean_log is None) == (r.n_words == 0)
    assert abs(rows[30].log_likelihood - rows[-2].log_likelihood) < 1e-6
    assert "text" not in rows[0].asDict() and mlm.score_words(docs.limit(0), net, counts).count() == 0


def test_unknown_words_score_by_spelling(spark):
    texts, rare = _corpus()
    docs = frame(spark, texts)
    counts = mlm.count_words(docs)
    net = mlm.fit(docs, counts=counts)
    probe = [" ".join(rare[:20]), " ".join(w[::-1] for w in rare[:20]), " ".join(["qzxvkjw"] * 20), "zq" * 500]
    rows = mlm.score_words(frame(spark, probe), net, counts).orderBy("doc_id").collect()
    scores = [r.mean_log for r in rows]
    assert scores[0] > scores[1] + 0.5 > scores[2] + 10 and all(map(math.isfinite, scores))
    assert abs(net.score([probe[0].encode()])[1][0] - net.score([probe[2].encode()])[1][0]) < 1e-3   # to the network they are one
