"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the average of the embeddings of its hashed character n-grams (words with boundary
marks, lower-cased); a linear layer and a softmax give the languages' probabilities.  Both layers
are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows; a
temperature is then fitted on sample rows left out of the descent (calibration), and a text whose
best probability is below ``reject`` is marked as rejected.

As the layers are linear, prediction needs one row of class scores for each n-gram bucket, so the
model sent to executors has BUCKETS x languages numbers whatever the corpus is.

Defined results: a null text or one without a letter is ``und`` with score 0 and rejected;
repeated rows get equal results; with no labelled row every text is ``und``; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import append, chunks, in_share, mix, raw_texts

BUCKETS, DIM, SIZES = 1 << 16, 16, (2, 3)
#: Bounds of the training sample, for each language: rows, and their texts' UTF-8 bytes for each of these rows.
SAMPLE, SAMPLE_BYTES = 800, 8000
UND = "und"


def _letters() -> np.ndarray:
    """Whether a code point of the basic plane is a letter; higher ones count as letters."""
    return np.array([chr(c).isalpha() for c in range(0x10000)])


_LETTER = _letters()
_FOLD = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(0x10000)], np.uint32)


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all n-grams, text of each): n-grams lie in a word of letters and its two ends."""
    codes = [np.frombuffer(t.decode("utf-8", "replace").encode("utf-32-le"), np.uint32) for t in texts]
    gap = np.array([32], np.uint32)
    joined = np.concatenate([gap, *[x for c in codes for x in (c, gap)]])
    text = np.repeat(np.arange(len(texts) + 1), [1, *[len(c) + 1 for c in codes]]) - 1
    low = joined < 0x10000
    small = np.where(low, joined, 0)
    letter = np.where(low, _LETTER[small], True)
    code = np.where(letter, np.where(low, _FOLD[small], joined), 32).astype(np.uint64)
    # one mark between words: gaps after gaps are dropped
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code, text, letter = code[keep], text[keep], letter[keep]
    found, owner = [], []
    for size in SIZES:
        n = len(code) - size + 1
        if n <= 0:
            continue
        h = np.full(n, size, np.uint64)
        inner = np.ones(n, bool)
        for k in range(size):
            h = h * np.uint64(0x100000001B3) + code[k:k + n]
            if 0 < k < size - 1:
                inner &= letter[k:k + n]
        if size == 1:
            inner &= letter
        inner &= text[:n] == text[size - 1:size - 1 + n]
        found.append((mix(h[inner]) & np.uint64(BUCKETS - 1)).astype(np.int32))
        owner.append(text[:n][inner])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(owner)


def has_letter(texts: list[bytes]) -> np.ndarray:
    return np.array([any(map(str.isalpha, t.decode("utf-8", "replace"))) for t in texts], bool)


class Model:
    """Class scores of each bucket (embedding times output layer), bias and temperature."""

    def __init__(self, langs: list[str], scores: np.ndarray, bias: np.ndarray, temperature: float):
        self.langs, self.scores, self.bias, self.temperature = langs, scores, bias, temperature

    def logits(self, texts: list[bytes]) -> np.ndarray:
        out = np.tile(self.bias, (len(texts), 1))
        for at, some in chunks(texts, 1 << 19):
            bucket, owner = grams(some)
            count = np.maximum(np.bincount(owner, minlength=len(some)), 1)
            for c in range(len(self.langs)):
                total = np.bincount(owner, self.scores[bucket, c], minlength=len(some))
                out[at:at + len(some), c] += total / count
        return out

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        if not self.langs:
            return [UND] * len(texts), np.zeros(len(texts))
        p = _softmax(self.logits(texts) / self.temperature)
        known = has_letter(texts)
        best = p.argmax(1)
        return ([self.langs[b] if k else UND for b, k in zip(best, known, strict=True)],
                np.where(known, p.max(1), 0.0))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def train(rows: list[tuple[bytes, str]], epochs: int = 4, rate: float = 0.5, seed: int = 11) -> Model:
    """Stochastic gradient descent over single rows; every tenth row of a language calibrates instead."""
    langs = sorted({lang for _, lang in rows})
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    rng = np.random.default_rng(seed)
    embed = rng.uniform(-1, 1, (BUCKETS, DIM)) / DIM
    out, bias = np.zeros((DIM, len(langs))), np.zeros(len(langs))
    inputs = [np.unique(grams([t])[0], return_counts=True) for t, _ in rows]
    target = [langs.index(lang) for _, lang in rows]
    held = np.zeros(len(rows), bool)
    for c in range(len(langs)):
        held[np.flatnonzero(np.array(target) == c)[9::10]] = True
    steps, done = epochs * max(1, int((~held).sum())), 0
    for _ in range(epochs):
        for i in rng.permutation(np.flatnonzero(~held)):
            bucket, count = inputs[i]
            if not len(bucket):
                continue
            share = count / count.sum()
            hidden = share @ embed[bucket]
            error = _softmax((hidden @ out + bias)[None])[0]
            error[target[i]] -= 1
            step = rate * (1 - done / steps)
            back = out @ error
            out -= step * np.outer(hidden, error) * DIM
            bias -= 0.1 * step * error
            embed[bucket] -= step * DIM * np.outer(share, back)
            done += 1
    model = Model(langs, embed @ out, bias, 1.0)
    check = [i for i in np.flatnonzero(held) if len(inputs[i][0])]
    if check:
        z, y = model.logits([rows[i][0] for i in check]), np.array([target[i] for i in check])
        loss = {t: -np.log(_softmax(z / t)[np.arange(len(y)), y] + 1e-12).mean() for t in 2.0 ** np.arange(-4, 5, 0.5)}
        model.temperature = float(min(loss, key=loss.get))
    return model


def sample(df: DataFrame, text: str, lang: str, key: str, rows: int = SAMPLE) -> list[tuple[bytes, str]]:
    """About ``rows`` different labelled rows of each language by a hash of key and text, or fewer if they are
    long: whole texts, of about ``rows`` * SAMPLE_BYTES bytes in all, and at least the row of smallest hash."""
    size, order = F.octet_length(text), F.xxhash64(key, text)
    labelled = df.filter(F.col(lang).isNotNull() & (size > 0))
    kinds = labelled.select(F.col(lang).alias("lang"), order.alias("order"), size.cast("long").alias("size")).dropDuplicates()
    counts = kinds.groupBy("lang").agg(F.count("*"), F.sum("size"), F.min("order")).collect()
    chosen: Column = F.lit(False)
    for name, n, total, least in counts:
        share = min(1.0, rows / n, rows * SAMPLE_BYTES / total)
        chosen = chosen | ((F.col(lang) == name) & (in_share(order, share) | (order == least)))
    picked = labelled.filter(chosen).select(key, text, lang).dropDuplicates().select(text, lang).collect()
    return sorted((r[0].encode("utf-8", "replace"), r[1]) for r in picked)


def fit(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    return train(sample(df, text, lang, key))


def identify(df: DataFrame, model: Model, text: str = "text", reject: float = 0.5) -> DataFrame:
    """``df`` with lang_pred, score (calibrated probability of it) and rejected."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        lang, score = shared.value.predict(raw_texts(batch, text))
        return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(score < reject, pa.bool_())]

    return append(df, [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())], columns)
