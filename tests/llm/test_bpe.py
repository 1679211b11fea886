import hashlib
import random

import numpy as np
import pytest

from plinth.llm import bpe
from plinth.llm.catalog import op1_bpe, ranks_path
from tests.llm.conftest import LONG, frame

tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("t", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(ranks_path()), special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(bpe.read_ranks(ranks_path()), bpe.code_classes())


def test_random_texts_match_the_library(library, coder):
    rng = random.Random(3)
    bits = ["'s", "'re", "'ll", "'x", "'", " ", "  ", "\n", "\t", " ", " ", "a", "Zoë", "re", "12", "٣", "!", "--",
            "中文", "\U0001f600", "é", "Ᲊ", "\x1c", "\x85", "​", "ve", "S", "'S", "_", "<|endoftext|>"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += ["", " ", "a" * 5000, " " * 3000 + "x", "'" * 40, "ab" * 4000, "\n" * 10]
    for text, ids in zip(texts, coder.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
        assert coder.decode(ids) == text.encode()
        edge = [*coder.offsets(ids).tolist(), len(text.encode())]
        assert [text.encode()[a:b] for a, b in zip(edge[:-1], edge[1:], strict=True)] == [coder.bytes[i] for i in ids]


def test_blocks_compose_to_the_plain_walk():
    rng = np.random.default_rng(0)
    cls = rng.integers(0, 10, 5000).astype(np.uint8)
    state, want = bpe.FRESH, []
    for c in cls:
        want.append(bool(bpe._NEW[c, state]))
        state = bpe._TO[c, state]
    for block in (1, 7, 512, 9000):
        assert bpe.piece_starts(cls, block).tolist() == want


def test_query_matches_the_library(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = op1_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = np.array(library.encode_ordinary(docs[r.doc_id] or ""), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()


def test_edge_rows(spark, library):
    texts = [None, "", "x", "x", LONG, "a'll b"]
    docs = frame(spark, texts, [1, None, 3, 3, 5, 6]).selectExpr("*", "1 AS ids", "2 AS n_tokens")
    vocabulary = bpe.Vocabulary(spark, ranks_path())
    rows = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).orderBy("n_chars").collect()
    assert sorted(r.n_tokens for r in rows) == sorted(len(library.encode_ordinary(t or "")) for t in texts)
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    once = bpe.round_trip(docs, vocabulary).orderBy("n_chars").collect()
    assert sorted(map(str, once)) == sorted(map(str, rows))
    short = bpe.round_trip(docs, vocabulary, keep_text=False)
    assert short.columns == [c for c in bpe.round_trip(docs, vocabulary).columns if c != "text"]
    assert sorted(map(str, short.collect())) == sorted(map(str, bpe.round_trip(docs, vocabulary).drop("text").collect()))
    assert bpe.decode(bpe.encode(docs.limit(0), vocabulary), vocabulary).count() == 0
