import re

from plinth.llm import quality
from plinth.llm.catalog import op4_quality
from tests.llm.conftest import LONG, frame

_WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = _WORD.findall(text)
    lines = [x for x in text.split("\n") if _WORD.search(x)]
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


def test_counts_match_brute_force(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = op4_quality(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert got == brute(texts[r.doc_id])
        assert r.base_failed == (got[0] < 20 or 100 * got[4] > 30 * got[0])
        assert not (r.base_failed and r.kept)


def test_edge_rows(spark):
    texts = [None, "", " \n\t", "a " * 30, LONG, LONG, "é  x y\n\nz\n\x0b\nz", "one two three four five six seven eight nine"]
    rows = quality.judge(frame(spark, texts).selectExpr("*", "'x' AS n_words", "0 AS quality")).orderBy("doc_id").collect()
    for r, t in zip(rows, texts, strict=True):
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(t)
    assert rows[4].kept == rows[5].kept
    assert quality.judge(frame(spark, [])).count() == 0


def test_agrees_with_labels(spark):
    got = op4_quality(spark, "/root/testdata/sf0.01").filter("NOT base_failed")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality")
    rows = got.select("doc_id", "kept").join(labels, "doc_id").collect()
    good, poor = [r for r in rows if r.quality == 1], [r for r in rows if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in poor) >= 0.9 * len(poor)


def test_model_recovers_planted_accuracies():
    n = len(quality.rules())
    agree, clash = tuple([1] * n), tuple([-1, -1] + [1] * (n - 2))
    share, logs = quality.fit({agree: 900, clash: 100})
    assert abs(share - 0.9) < 0.02
    assert logs[0, 0, 0] > logs[1, 0, 0] + 2
