import sys

import pytest

import corpus_pipeline
from plinth.llm import bpe, simhash
from plinth.llm.catalog import ranks_path
from plinth.llm.common import table
from tests.llm.conftest import LONG, frame
from tests.llm.test_decontam import brute as brute_hits
from tests.llm.test_simhash import brute_groups, brute_print
from tests.llm.test_substring import brute as brute_cut

D = "/root/testdata/sf0.001"


def test_stages_match_brute_force(spark):
    docs = table(spark, D, "documents")
    rows = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, D)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        rows[name] = (before, {r.doc_id: r.text for r in docs.collect()})
    before, after = rows["quality_rules"]
    assert 0.8 * len(before) < len(after) < len(before) and all(before[d] == t for d, t in after.items())
    before, after = rows["simhash_near_dedup"]
    prints = {d: brute_print(t) for d, t in before.items()}
    group, low = brute_groups(prints.values()), {}
    for d in sorted(prints, reverse=True):
        low[group[prints[d]]] = d
    assert after == {d: before[d] for d in low.values()}
    before, after = rows["substring_dedup"]
    assert after == {d: t for d, (t, _) in brute_cut(sorted(before.items())).items()}
    before, after = rows["decontaminate"]
    items = [(r.item_id, r.text) for r in table(spark, D, "benchmark").collect()]
    assert after == {d: t for d, t in before.items() if not brute_hits(t, items)[-1]}
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    library = tiktoken.Encoding("t", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(ranks_path()), special_tokens={})
    last = corpus_pipeline.STAGES[-1][1](spark, docs, D).collect()
    assert {r.doc_id: r.ids for r in last} == {d: library.encode_ordinary(t) for d, t in after.items()}


def test_run_and_registration(spark):
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, D).count() > 100
    assert "plinth.llm" in sys.modules


def test_edge_rows_of_each_stage(spark):
    prose = " ".join(f"Every day {a} walks to {b} and comes home." for a, b in zip("abcdefgh", "stuvwxyz", strict=True))
    texts = [None, "", LONG, prose, prose, prose, prose + " More."]
    docs = frame(spark, texts, [1, 2, 3, 5, 5, None, None]).selectExpr("*", "7 AS kept", "8 AS fp", "9 AS n_hit", "'z' AS id")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, D).columns == docs.columns
        assert stage(spark, docs.limit(0), D).count() == 0
    kept = corpus_pipeline.simhash_near_dedup(spark, docs.filter("text LIKE 'Every%'"), D).collect()
    assert 5 in [r.doc_id for r in kept] and len(kept) <= 2
    nameless = corpus_pipeline.simhash_near_dedup(spark, docs.filter("doc_id IS NULL"), D).collect()
    assert 1 <= len(nameless) <= 2 and all(r.text.startswith(prose) for r in nameless)
    assert corpus_pipeline.byte_bpe(spark, docs, D).count() == 7


def test_unlike_texts_under_one_id_stay(spark):
    """One row of each group, also where ids are repeated or missing."""
    prose = [" ".join(f"{w} day {a} walks to {b}{k} and comes home." for a, b in zip("abcdefghij", "qrstuvwxyz", strict=True))
             for k, w in enumerate(["Every", "No", "Some"])]
    texts = [prose[0], prose[1], prose[1], prose[2], prose[2], prose[0], prose[0], prose[2] + " More.", prose[2]]
    ids = [1, 1, 1, 2, None, 3, 1, None, 9]
    prints = simhash.with_fingerprint(frame(spark, texts, ids)).collect()
    group = brute_groups({r.fp for r in prints})
    want = {}
    for r in sorted(prints, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.fp, r.text)):
        want.setdefault(group[r.fp], (r.doc_id, r.text))
    got = corpus_pipeline.simhash_near_dedup(spark, frame(spark, texts, ids), D).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(want.values()) and {prose[0], prose[1]} <= {r.text for r in got if r.doc_id == 1}
