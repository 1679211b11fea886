import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from plinth.llm import align
from plinth.llm.catalog import op11_align
from tests.llm.conftest import LONG, frame

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pair():
    return align.load(A, B)


@pytest.fixture(scope="module")
def tools():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def b_piece(model, i):
    p = model.id_to_piece(i)
    return bytes.fromhex(p[3:5]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()


def brute(text, tools):
    """(A tokens, B tokens, groups, links) of one text: ends as sets, overlaps from all ranges."""
    a_tool, b_tool = tools
    if not text:
        return [], [], [], []
    a = a_tool.encode(" " + text, add_special_tokens=False).ids
    b = b_tool.encode(text)
    a_bytes = [bytes(LETTERS[c] for c in a_tool.id_to_token(i)) for i in a]
    b_bytes = [b_piece(b_tool, i) for i in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], [], []
    a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
    cuts = sorted(set(a_end) & set(b_end))
    groups = [([], []) for _ in cuts]
    for side, ids, ends in ((0, a, a_end), (1, b, b_end)):
        for i, e in zip(ids, ends, strict=True):
            groups[bisect.bisect_left(cuts, e)][side].append(i)
    at_a, at_b = dict(zip(a_end, a)), dict(zip(b_end, b))
    return a, b, groups, [(at_a[c], at_b[c]) for c in cuts]


def enumerate_letters():
    """byte -> letter, by the published rule of byte-level BPE."""
    out, n = {}, 0
    for b in range(256):
        if chr(b).isprintable() and b not in (32, 160, 173) and not 127 <= b < 161:
            out[b] = chr(b)
    for b in range(256):
        if b not in out:
            out[b], n = chr(256 + n), n + 1
    return out


LETTERS = {v: k for k, v in enumerate_letters().items()}


def expected(texts, tools):
    found = {k: brute(t, tools) for k, t in texts.items()}
    counts = Counter(x for f in found.values() for x in f[3])
    top = {}
    for (_, b), n in counts.items():
        top[b] = max(top.get(b, 0), n)
    out = {}
    for k, (a, b, groups, links) in found.items():
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[k] = (len(a), len(b), len(groups), len(links), sum(counts[x] == top[x[1]] for x in links),
                  sum(counts[x] for x in links), hashlib.sha256(line.encode()).hexdigest() if a else "")
    return out


def test_query_matches_brute_force(spark, tools):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    rows = {r.doc_id: tuple(r)[1:] for r in op11_align(spark, d).collect()}
    assert rows == expected(texts, tools) and sum(r[2] > 0 for r in rows.values()) > 100


ODD = ["a", " ", "  two  spaces ", "\n\nline\tbreak\r\n", "Straße 東京 🙂 naïve", "<|endoftext|> and </s> <s> <unk> <0x41>",
       "x▁y", "▁", "é ﬁ", "don't we'll I'd", "12345 67 8,9", "\x00\x01", "=" * 50, "a" * 300, "tab\t\tend "]


def test_odd_texts_and_edge_rows(spark, pair, tools):
    texts = [None, "", *ODD, *ODD[:3], LONG]
    docs = frame(spark, texts).selectExpr("*", "'x' AS n_a", "7 AS links")
    rows = {r.doc_id: tuple(r)[1:] for r in align.aligned_scores(docs, pair).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()}
    assert rows == expected(dict(enumerate(texts)), tools)
    assert rows[0] == rows[1] == (0, 0, 0, 0, 0, 0, "")
    assert align.aligned_scores(frame(spark, []), pair).count() == 0


def test_long_texts_are_cut_without_a_trace(pair, tools, monkeypatch):
    rng = random.Random(3)
    words = ["alpha", "Übung", "it's", "42", "x.", "(y", "東京", "don't", "  ", "\n", "under_score", "ing", "a"]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(20)]
    a_tool, b_tool = tools
    texts += [*ODD, "x▁y z", "", "one"]
    whole = [(a_tool.encode(" " + t, add_special_tokens=False).ids, b_tool.encode(t)) if t and "▁" not in t else ([], [])
             for t in texts]
    monkeypatch.setattr(align, "SENTENCE", 3)
    a, b, counts = pair.encode(texts)
    assert counts.tolist() == [[len(x), len(y)] for x, y in whole]
    assert a.tolist() == [i for x, _ in whole for i in x] and b.tolist() == [i for _, x in whole for i in x]
    monkeypatch.setattr(align, "KEPT_WORDS", 5)                           # words are forgotten again and again
    again = [pair.encode([t]) for t in texts]
    assert np.concatenate([x[0] for x in again]).tolist() == a.tolist() and np.concatenate([x[1] for x in again]).tolist() == b.tolist()
    monkeypatch.setattr(align, "BLOCK_CHARS", 40)
    for t, want in zip(texts, whole, strict=True):
        found = align.Aligned(pair, [t.encode()])
        assert (found.a.tolist(), found.b.tolist()) == want
    found = align.Aligned(pair, [("word " * 100 + "x▁y " + "word " * 100).encode()])
    assert not len(found.a) and not found.counts.any() and found.digests(pair) == [""]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_pieces_of_any_size_give_the_same_overlaps(size):
    rng = random.Random(size)
    for _ in range(200):
        n = rng.randint(0, 40)
        a, b = (np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(0, n)), n} - {0}), np.int64) for _ in "ab")
        got = list(zip(*(x.tolist() for x in align.overlaps(a, b, size)), strict=True))
        ranges = [list(zip([0, *e.tolist()], e.tolist())) for e in (a, b)]
        assert got == [(i, j) for i, (s, e) in enumerate(ranges[0]) for j, (t, f) in enumerate(ranges[1]) if s < f and t < e]
        i, j = align.path_cuts(a, b, size)
        assert set(np.diff(i + j)[:-1].tolist()) <= {size} and i[-1] == len(a) and j[-1] == len(b)


def test_columns_of_the_operator(spark, pair):
    r = align.align(frame(spark, ["Straße 東京 don't", None]), pair).orderBy("doc_id").collect()
    assert r[0].text == "Straße 東京 don't" and sum(r[0].a_sizes) == len(r[0].a_ids) == r[0].n_a
    assert sum(r[0].b_sizes) == len(r[0].b_ids) and len(r[0].links) == r[0].n_groups == len(r[0].a_sizes)
    ends = [np.cumsum([len(v[i]) for i in ids]) for v, ids in ((pair.a_bytes, r[0].a_ids), (pair.b_bytes, r[0].b_ids))]
    both = [(a, b) for a, b in zip(r[0].overlap_a, r[0].overlap_b) if ends[0][a] == ends[1][b]]
    assert [x for x in r[0].links] == [r[0].a_ids[a] * len(pair.b_bytes) + r[0].b_ids[b] for a, b in both]
    assert r[1].a_ids == r[1].overlap_b == [] and r[1].groups_sha256 == ""


def test_linked_pairs_are_bounded_by_the_vocabularies(pair):
    suffixes = {t: i for i, t in enumerate(pair.b_bytes)}
    assert 10_000 < pair.bound < 64 * len(suffixes)
