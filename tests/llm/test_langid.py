import numpy as np

from plinth.llm import langid
from plinth.llm.catalog import op3_langid
from tests.llm.conftest import LONG, frame

_SAYINGS = {"en": b"the house and the garden are with this thing", "de": "der Garten und das Haus sind schön über nicht".encode()}


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    rows = op3_langid(spark, d).join(spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.lang]
    assert len(rows) == 1000 and len(held) > 100
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_score_is_calibrated_and_ngram_scores_add_up():
    rng = np.random.default_rng(0)
    rows = [(b" ".join(rng.choice(t.split(), 12)), lang) for lang, t in _SAYINGS.items() for _ in range(60)]
    model = langid.train(rows)
    assert model.predict([b"the garden thing", "schön über das".encode()])[0] == ["en", "de"]
    text = b"the Garden"
    bucket, _ = langid.grams([text])
    want = model.scores[bucket].mean(0) + model.bias
    assert np.allclose(model.logits([b"x", text, b""])[1], want)


def test_grams_by_hand():
    joined, owner = langid.grams([b"Ab c", b"", b"1 d"])
    alone = [langid.grams([t])[0].tolist() for t in (b"Ab c", b"", b"1 d")]
    assert [sorted(joined[owner == i].tolist()) for i in range(3)] == [sorted(a) for a in alone]
    assert len(alone[0]) == 4 + 2 and not alone[1]             # ab, b_, _c, c_ and ab_, _c_ (b_c is no word)


def test_edge_rows(spark):
    texts = [None, "", "123 --", "x", LONG, LONG]
    docs = frame(spark, texts).selectExpr("*", "1 AS score", "2 AS lang_pred")
    model = langid.train([(t, lang) for lang, t in _SAYINGS.items()])
    rows = langid.identify(docs, model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in rows[:3]] == ["und"] * 3 and all(r.rejected and r.score == 0 for r in rows[:3])
    assert rows[4].lang_pred == rows[5].lang_pred in ("en", "de") and rows[4].score == rows[5].score
    assert langid.identify(frame(spark, []), model).count() == 0
    nothing = langid.fit(frame(spark, []))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}
