import numpy as np

from plinth.llm import substring
from plinth.llm.common import Words, mix
from tests.llm.conftest import frame


def words_of(seed, n):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n)]


def pieces(text):
    s = substring.Sentences([text.encode()])
    return [(int(a), int(b)) for a, b in zip(s.first, s.stop, strict=True)]


def test_fallback_cuts_by_hand():
    words = words_of(1, 40) + ["same"] * 15
    key = mix(Words([" ".join(words).encode()]).hash).tolist()
    after = set()
    for k in range(len(words) - substring.LONG + 1):
        window = key[k:k + substring.LONG]
        after.add(k + max(i for i, x in enumerate(window) if x == min(window)) + 1)
    edges = sorted({0, len(words), *after})
    assert pieces(" ".join(words)) == list(zip(edges[:-1], edges[1:], strict=True))
    assert max(b - a for a, b in pieces(" ".join(words))) <= substring.LONG
    assert pieces(" ".join(words[:12])) == [(0, 12)]


def test_markless_passage_goes_at_any_offset(spark):
    for n in (55, 80):
        passage = words_of(2, n)
        texts = [" ".join([*words_of(10 + k, k), *passage, *words_of(90 + k, 9)]) for k in range(0, 26)]
        rows = substring.dedup(frame(spark, texts)).orderBy("doc_id").collect()
        for k, r in enumerate(rows):
            left = set(r.text.split()) & set(passage)
            assert len(left) == n if k == 0 else len(left) <= 2 * substring.LONG
            assert set(texts[k].split()) - set(passage) <= set(r.text.split())
