import numpy as np

from plinth.llm import toxicity
from plinth.llm.catalog import op7_toxicity
from tests.llm.conftest import LONG, frame


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic", "quality")
    rows = op7_toxicity(spark, d).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out and r.toxic is not None]
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert len(toxic) > 100
    assert np.mean([r.predicted for r in toxic]) >= 0.85
    assert np.mean([r.predicted for r in clean]) <= 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_label_model_separates_and_discounts_copies():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    votes = np.zeros((4000, 10), int)
    for j in range(4):
        votes[:, j] = np.where(truth & (rng.random(4000) < 0.7), 1, 0)
    votes[:, 4] = votes[:, 3]                                     # a voter that repeats another one
    for j in range(6, 10):
        votes[:, j] = np.where(rng.random(4000) < 0.9, np.where(truth, 1, -1), 0)
    counts = {}
    for v in map(tuple, votes.tolist()):
        counts[v] = counts.get(v, 0) + 1
    found = toxicity.label_model(counts)
    right = np.mean([(found[tuple(v)] > 0.5) == t for v, t in zip(votes.tolist(), truth, strict=True)])
    assert right > 0.97
    v = np.array(list(counts))
    near = toxicity._correlations(v, np.array(list(counts.values()), float), np.array(list(found.values())))
    assert near[3, 4] > 0.85 and abs(near[0, 1]) < 0.2


def test_lexicon_hits():
    lexicon = toxicity.Lexicon(["scum", "schund*", "ab"])
    n, hits = lexicon.hits("SCUM scums, Schund schundig ab abc".encode())
    assert (n, hits) == (6, [(0, 0), (1, 3), (2, 4)])


def test_edge_rows(spark):
    texts = [None, "", "fine words here", "idiot scum", "idiot scum", LONG + " idiot"]
    docs = frame(spark, texts).selectExpr("*", "'x' AS score", "'y' AS votes")
    letters = ["".join(chr(97 + (i // d) % 9) for d in (1, 9)) for i in range(80)]
    many = frame(spark, [f"idiot scum q{x} z{x}" if i % 2 else f"good v{x} w{x}" for i, x in enumerate(letters)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(80)] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(many, labels)
    assert {"idiot", "scum"} <= set(model.lexicon.entries) or {"idio*", "scum"} <= set(model.lexicon.entries)
    rows = toxicity.score(docs, model).orderBy("doc_id").collect()
    assert rows[0].score == rows[1].score < 0.7 and rows[3].score == rows[4].score >= 0.7
    assert toxicity.score(frame(spark, []), model).count() == 0
    empty = toxicity.fit(frame(spark, []), labels.limit(0))
    assert len({r.score for r in toxicity.score(docs, empty).collect()}) == 1
