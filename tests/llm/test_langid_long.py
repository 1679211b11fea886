import numpy as np

from plinth.llm import langid

_WORDS = {"en": "the house and garden are with this thing".split(), "de": "der Garten und das Haus sind schön über nicht".split(),
          "cy": "mae ddim yn gwybod llyfr cyfraith ysgol bydd".split()}


def _docs(spark, sizes):
    rng = np.random.default_rng(3)
    rows = [(lang, " ".join(rng.choice(_WORDS[lang], n))) for lang, ns in sizes.items() for n in ns]
    return spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")


def test_language_of_long_texts_only_is_learned(spark):
    docs = _docs(spark, {"en": [30] * 60, "de": [30] * 60, "cy": [4000] * 25})
    assert docs.filter("lang = 'cy' AND octet_length(text) <= 8000").count() == 0
    model = langid.fit(docs)
    assert model.langs == ["cy", "de", "en"]
    assert model.predict([b"llyfr cyfraith yn ysgol", b"the house with the garden"])[0] == ["cy", "en"]


def test_sample_is_bounded_and_has_every_language(spark):
    docs = _docs(spark, {"en": [30] * 900, "de": [5000] * 300, "cy": [200_000]})
    rows = langid.sample(docs.union(docs), "text", "lang", "doc_id", 100)
    size = {lang: [len(t) for t, x in rows if x == lang] for lang in _WORDS}
    assert 60 < len(size["en"]) < 160 and len(size["cy"]) == 1 and 0 < sum(size["de"]) < 2 * 100 * langid.SAMPLE_BYTES
    assert max(size["de"]) > langid.SAMPLE_BYTES


def test_single_row_of_a_language_trains():
    rows = [(b"the house and the garden", "en")] * 9 + [("llyfr cyfraith ysgol".encode(), "cy")] + [(b"the thing", "en")]
    assert langid.train(rows).predict([b"llyfr ysgol"])[0] == ["cy"]
