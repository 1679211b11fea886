from plinth.llm import substring
from tests.llm.conftest import frame
from tests.llm.test_substring_cuts import words_of


def brute(docs):
    """(text, sentences removed) by id: every shortest run from, and up to, each sentence."""
    cut, low = {}, {}
    for d, t in docs:
        s = substring.Sentences([t.encode()])
        pieces = [t.encode().lower().split()[a:b] for a, b in zip(s.first, s.stop, strict=True)]
        spans = {(i, j) for i in range(len(pieces)) for j in range(i + 1, len(pieces))
                 if sum(map(len, pieces[i:j + 1])) >= substring.MIN_WORDS}
        runs = {(i, j) for i, j in spans if (i, j - 1) not in spans or (i + 1, j) not in spans}
        cut[d] = (s, [(tuple(w for p in pieces[i:j + 1] for w in p), i, j) for i, j in sorted(runs)])
        for key, i, _ in cut[d][1]:
            low[key] = min(low.get(key, (d, i)), (d, i))
    out = {}
    for d, t in docs:
        s, found = cut[d]
        gone = {k for key, i, j in found if low[key] != (d, i) for k in range(i, j + 1)}
        start = [*s.words.start[s.first].tolist(), len(t.encode())]
        kept = t.encode()[:start[0]] + b"".join(t.encode()[start[k]:start[k + 1]] for k in range(len(start) - 1) if k not in gone)
        out[d] = (kept.decode() if gone else t, len(gone))
    return out


def sentence(seed, n):
    return " ".join(words_of(seed, n)) + "."


def test_tail_of_a_repeated_span_goes(spark):
    span = " ".join(sentence(k, n) for k, n in enumerate((10, 10, 4)))
    texts = [f"{sentence(20, 9)} {span} {sentence(21, 9)}", f"{sentence(30, 9)} {span} {sentence(31, 9)}", f"{sentence(40, 9)} {span}"]
    rows = substring.dedup(frame(spark, texts)).orderBy("doc_id").collect()
    assert rows[0].text == texts[0] and [r.n_removed for r in rows] == [0, 3, 3]
    assert rows[1].text == f"{sentence(30, 9)} {sentence(31, 9)}" and rows[2].text.strip() == sentence(40, 9)


def test_matches_brute_force(spark, documents):
    docs = sorted((r.doc_id, r.text) for r in documents.collect() if r.text and len(r.text) < 6000)
    rows = substring.dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.text, r.n_removed) for r in rows} == brute(docs)
    assert len(docs) > 50 and any(r.n_removed for r in rows)


def test_a_run_is_listed_once():
    s = substring.Sentences([f"{sentence(1, 8)} {sentence(2, 8)} {sentence(3, 8)}".encode(), b"", sentence(1, 8).encode()])
    assert list(zip(s.run.tolist(), s.run_to.tolist(), strict=True)) == [(0, 1), (1, 2)]
    assert not s.repeats_inside().any() and len(substring.Sentences([b""]).run) == 0
