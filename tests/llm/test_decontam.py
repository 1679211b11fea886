import hashlib
import random
import re

from plinth.llm import decontam
from plinth.llm.catalog import op5_decontaminate
from tests.llm.conftest import LONG, frame

_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items):
    w, hit, found = words(text), set(), set()
    at = {}
    for i in range(len(w)):
        at.setdefault(w[i], []).append(i)
    for k, t in items:
        seq = words(t)
        size = min(13, len(seq))
        for j in range(len(seq) - size + 1 if seq else 0):
            for i in at.get(seq[j], ()):
                if w[i:i + size] == seq[j:j + size]:
                    hit |= set(range(i, i + size))
                    found.add(str(k))
    return len(w), len(hit), len(found), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def check(rows, texts, items):
    for r in rows:
        n, hit, found, names, bad = brute(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, found, bad), r.doc_id
        if "items_sha256" in r:
            assert r.items_sha256 == hashlib.sha256(",".join(names).encode()).hexdigest()
        else:
            assert r["items"] == names


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    rows = op5_decontaminate(spark, d).collect()
    assert len(rows) == len(texts) and any(r.contaminated for r in rows)
    check(rows, texts, items)


def test_random_small_alphabet(spark, monkeypatch):
    rng = random.Random(1)
    items = [(k, " ".join(rng.choices("abc", k=rng.choice([1, 2, 5, 12, 13, 14, 20, 30])))) for k in range(12)]
    items += [(3, "zz Yy xx"), (20, None), (21, ""), (None, "q q"), (22, "?!")]
    texts = [" ".join(rng.choices("abcd", k=rng.randint(0, 80))) for _ in range(60)] + ["ZZ, yy-XX!", None, "", "q q", "a"]
    named = [(k, t) for k, t in items if k is not None]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.mark(frame(spark, texts), benchmark).collect()
    check(rows, dict(enumerate(texts)), named)
    long_only = [(k, t) for k, t in named if t and len(words(t)) >= 12]
    rows = decontam.mark(frame(spark, texts), spark.createDataFrame(long_only, "item_id long, text string")).collect()
    check(rows, dict(enumerate(texts)), long_only)
    monkeypatch.setattr(decontam, "MAX_ITEM_BYTES", 60)                   # several shards of items
    rows = decontam.mark(frame(spark, texts), benchmark).collect()
    check(rows, dict(enumerate(texts)), named)


def test_edge_rows(spark):
    passage = " ".join(f"w{i}" for i in range(15))
    texts = [None, "", LONG + passage, passage.upper() + " tail", passage, passage]
    docs = frame(spark, texts).selectExpr("*", "1 AS spans", "2 AS n_words")
    benchmark = spark.createDataFrame([(1, passage)], "item_id long, text string")
    marked = decontam.mark(docs, benchmark)
    rows = marked.orderBy("doc_id").collect()
    assert [r.contaminated for r in rows] == [False, False, False, True, True, True]
    assert rows[2].n_hit == 15 and rows[2].longest == 15
    clean = {r.doc_id: r.text for r in decontam.remove_spans(marked).collect()}
    assert clean[0] is None and clean[2] == LONG and clean[3] == " tail" and clean[4] == ""
    assert decontam.mark(frame(spark, []), benchmark).count() == 0
    assert not any(r.contaminated for r in decontam.mark(docs, benchmark.limit(0)).collect())
