"""Toxicity by weak supervision.

1. A lexicon: words and word beginnings whose document frequency, over a bounded sample of
   labelled rows without near copies, marks toxic rows.
2. Voters: lexicon voters (the entries dealt out by rank; each votes toxic or abstains) and
   pattern voters (density, several different entries, entries close together, none at all).
3. A generative label model over the counts of vote patterns of all rows: expectation-maximisation
   estimates each voter's vote rates for both classes, and the pairwise correlations that remain
   given the class; a voter's evidence is divided by how much its correlated fellows repeat it.
4. A linear classifier is trained by gradient descent on the posteriors, and scores every text.

The driver holds the lexicon (ENTRIES at most), one row for each vote pattern (at most
2 ** LEXICON_VOTERS * 3 ** PATTERN_VOTERS) and a training sample of at most about 2 * TRAIN rows:
the TRAIN heaviest groups of rows with equal votes and counts, and of the others, by hash, about
TRAIN that stand for all of them by weight.

Defined results: a null or empty text has no hit and gets the score of such texts; repeated rows
get equal results; without labelled rows the lexicon is empty and all texts score alike; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import append, in_share, raw_texts, written

#: Bounds: lexicon entries, labelled rows of each class for the lexicon, half the rows for the classifier.
ENTRIES, SAMPLE, TRAIN = 96, 3000, 20000
LEXICON_VOTERS, PATTERN_VOTERS = 6, 4
#: Lengths of word beginnings; hits per 100 words from which a lone hit makes its voter vote.
PREFIXES, LONE = (5, 6, 7), 0.4
_WORD = re.compile(r"[^\W\d_]+")


def _tokens(text: bytes) -> list[str]:
    return _WORD.findall(text.decode("utf-8", "replace").lower())


def _entries(words: set[str]) -> set[str]:
    return words | {f"{w[:k]}*" for w in words for k in PREFIXES if len(w) > k}


def learn_lexicon(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                  label: str = "toxic", rows: int = SAMPLE) -> list[str]:
    """The entries, best first, from about ``rows`` labelled rows of each class (at most twice as
    many), chosen by a hash of the key; so the labels joined to the texts are few."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    counts = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    if len(counts) < 2:
        return []
    share = [F.col("label").eqNullSafe(c) & in_share(F.xxhash64("key"), rows / n) for c, n in counts.items()]
    few = known.filter(share[0] | share[1]).groupBy("key").agg(F.min("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(4 * rows)
    picked = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).filter(F.length("text") > 0)
    picked = picked.join(F.broadcast(few), "key").select("text", "label")

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        words = [_tokens(t) for t in raw_texts(batch, "text")]
        # near copies share most runs of five words, so mostly the smallest of their hashes
        low = [min((hash_run(w[i:i + 5]) for i in range(max(1, len(w) - 4))), default=0) for w in words]
        return [pa.array(low, pa.int64()), pa.array([sorted(_entries(set(w))) for w in words], pa.list_(pa.string()))]

    found = append(picked, [("low", T.LongType()), ("entries", T.ArrayType(T.StringType()))], columns).drop("text")
    unique = found.groupBy("low", "label").agg(F.min("entries").alias("entries"))
    unique = unique.select("label", F.explode("entries").alias("entry"))
    sizes = found.groupBy("label").agg(F.count_distinct("low")).collect()
    n = {r[0]: r[1] for r in sizes}
    if not n.get(1) or not n.get(0):
        return []
    table = unique.groupBy("entry").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    least = max(3, 0.008 * n[1])
    odds = ((F.col("a") + 0.5) / (n[1] + 1)) / ((F.col("b") + 0.5) / (n[0] + 1))
    good = table.filter((F.col("a") >= least) & (odds >= 30)).withColumn("gain", F.col("a") * F.log(odds))
    best = good.orderBy(F.desc("gain"), F.desc(F.length("entry")), "entry").limit(20 * ENTRIES).collect()
    out: dict[str, int] = {}
    for r in best:
        entry, head = r["entry"], r["entry"].rstrip("*")
        # what a chosen beginning covers adds nothing, nor does a beginning hardly more frequent
        # than a chosen word that it begins
        if any(e[-1] == "*" and head.startswith(e[:-1]) for e in out):
            continue
        if entry != head and any(e.startswith(head) and r["a"] < 1.3 * a for e, a in out.items()):
            continue
        out[entry] = r["a"]
        if len(out) == ENTRIES:
            break
    return list(out)


def hash_run(words: list[str]) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(" ".join(words).encode()) >> 1


class Lexicon:
    """Finds entries (whole words, or beginnings that end in *) in texts."""

    def __init__(self, entries: list[str]):
        self.entries = entries
        self.exact = {e: i for i, e in enumerate(entries) if not e.endswith("*")}
        self.start = {e[:-1]: i for i, e in enumerate(entries) if e.endswith("*")}
        self.heads = {e[:PREFIXES[0]] for e in (*self.exact, *self.start)}

    def hits(self, text: bytes) -> tuple[int, list[tuple[int, int]]]:
        """(words of the text, (entry, word number) of each hit)."""
        words, heads, k = _tokens(text), self.heads, PREFIXES[0]
        out = []
        for i in [i for i, w in enumerate(words) if w[:k] in heads]:
            entry = self.exact.get(words[i])
            for size in PREFIXES:
                if entry is None and len(words[i]) > size:
                    entry = self.start.get(words[i][:size])
            if entry is not None:
                out.append((entry, i))
        return len(words), out

    def columns(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(votes by text and voter, counts of each entry by text)."""
        votes = np.zeros((len(texts), LEXICON_VOTERS + PATTERN_VOTERS), np.int8)
        counts = np.zeros((len(texts), len(self.entries)), np.int32)
        for i, text in enumerate(texts):
            size, hits = self.hits(text)
            for e, _ in hits:
                counts[i, e] += 1
            kinds, rate = {e for e, _ in hits}, 100 * len(hits) / max(size, 1)
            if len(hits) > 1 or rate >= LONE:
                votes[i, [e % LEXICON_VOTERS for e in kinds]] = 1
            near = any(x != y and b - a <= 20 for (x, a), (y, b) in zip(hits, hits[1:], strict=False))
            votes[i, LEXICON_VOTERS:] = (1 if rate >= 0.5 else -1 if rate < 0.1 else 0, 1 if len(kinds) > 1 else 0 if kinds else -1,
                                         int(near), 0 if hits else -1)
        return votes, counts


def label_model(counts: dict[tuple[int, ...], int], steps: int = 300) -> dict[tuple[int, ...], float]:
    """Posterior probability of toxic for each vote pattern."""
    if not counts:
        return {}
    votes = np.array(list(counts), np.int64)
    weight = np.array(list(counts.values()), float)
    onehot = np.eye(3)[votes + 1]
    prior = np.empty((2, votes.shape[1], 3))
    prior[0], prior[1] = (4.0, 4.0, 0.1), (0.1, 2.0, 4.0)
    toxic = np.where((votes > 0).sum(1) > (votes < 0).sum(1), 0.9, 0.05)
    shrink = np.ones(votes.shape[1])
    for step in range(steps):
        rates = np.stack([np.einsum("p,prv->rv", weight * r, onehot) for r in (1 - toxic, toxic)]) + prior
        logs = np.log(rates / rates.sum(2, keepdims=True))
        share = (weight @ toxic + 1) / (weight.sum() + 2)
        if step % 10 == 9:
            shrink = 1 + np.clip(_correlations(votes, weight, toxic), 0, 1).sum(1)
        score = math.log(share / (1 - share)) + np.einsum("prv,rv->p", onehot, (logs[1] - logs[0]) / shrink[:, None])
        now = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        if step > 20 and np.abs(now - toxic).max() < 1e-9:
            break
        toxic = now
    return dict(zip(counts, toxic.tolist(), strict=True))


def _correlations(votes: np.ndarray, weight: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Correlations of the voters' votes given the class (zero on the diagonal); a variance of the
    order of 0.001, of votes that the class all but fixes, counts as noise."""
    total = np.zeros((votes.shape[1],) * 2)
    for r in (weight * toxic, weight * (1 - toxic)):
        away = votes - (r @ votes) / max(r.sum(), 1e-9)
        total += (away * r[:, None]).T @ away
    scale = np.sqrt(np.diag(total) + 0.001 * weight.sum())
    out = total / np.outer(scale, scale)
    np.fill_diagonal(out, 0)
    return out


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 400, rate: float = 0.5,
          decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels of weighted rows, by gradient descent with momentum."""
    weight = weight / max(weight.sum(), 1e-9)
    w, b = np.zeros(x.shape[1]), 0.0
    speed, speed_b = np.zeros_like(w), 0.0
    for _ in range(steps if len(x) else 0):
        error = weight * (1 / (1 + np.exp(-np.clip(x @ w + b, -50, 50))) - y)
        speed = 0.9 * speed - rate * (x.T @ error + decay * w)
        speed_b = 0.9 * speed_b - rate * error.sum()
        w, b = w + speed, b + speed_b
    return w, float(b)


def inputs(counts: np.ndarray, votes: np.ndarray) -> np.ndarray:
    return np.hstack([np.log1p(counts), votes > 0, votes < 0]).astype(float)


class Model:
    def __init__(self, lexicon: Lexicon, weights: np.ndarray, bias: float):
        self.lexicon, self.weights, self.bias = lexicon, weights, bias

    def score(self, texts: list[bytes]) -> np.ndarray:
        votes, counts = self.lexicon.columns(texts)
        return 1 / (1 + np.exp(-np.clip(inputs(counts, votes) @ self.weights + self.bias, -50, 50)))


def training_groups(groups: DataFrame, rows: int = TRAIN) -> list[Row]:
    """(votes, counts, weight): the ``rows`` groups of largest n as they are, and about as many of the
    others by a hash, whose weights are scaled to the sum of n of all the others."""
    spread = F.xxhash64("votes", "counts")
    keyed = groups.select("votes", "counts", "n", spread.alias("spread"))
    sizes = keyed.groupBy("n").agg(F.count("*").alias("groups")).orderBy(F.desc("n")).limit(rows + 1).collect()
    # all groups of a size above `least` are heavy; those of that size too, where there is place
    taken, least = 0, 0
    for r in sizes:
        if taken + r["groups"] > rows:
            least = r["n"]
            break
        taken += r["groups"]
    heavy = keyed.filter(F.col("n") > least).collect()
    tail = keyed.filter(F.col("n") <= least)
    total = tail.agg(F.count("*").alias("groups"), F.sum("n").alias("n")).first()
    if not total["groups"]:
        return [Row(votes=r["votes"], counts=r["counts"], weight=float(r["n"])) for r in heavy]
    place = F.pmod("spread", F.lit(1_000_000))
    light = tail.filter(place < int(1_000_000 * min(1.0, rows / total["groups"])) + 1).collect()
    scale = total["n"] / max(sum(r["n"] for r in light), 1)
    return [Row(votes=r["votes"], counts=r["counts"], weight=r["n"] * f) for some, f in ((heavy, 1.0), (light, scale)) for r in some]


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Lexicon from the labelled rows; label model and classifier from the votes on all rows."""
    spark = docs.sparkSession
    entries = learn_lexicon(docs, labels, key, text, label)

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        votes, counts = Lexicon(entries).columns(raw_texts(batch, "text"))
        return [pa.array(votes.tolist(), pa.list_(pa.int8())), pa.array(counts.tolist(), pa.list_(pa.int32()))]

    voted = append(docs.select(F.col(text).alias("text")), [("votes", T.ArrayType(T.ByteType())), ("counts", T.ArrayType(T.IntegerType()))], columns)
    # rows of equal counts and votes are one weighted row: those without a hit, above all
    groups = written(voted.groupBy("votes", "counts").agg(F.count("*").alias("n")), "votes")
    pattern = {tuple(r["votes"]): r["n"] for r in groups.groupBy("votes").agg(F.sum("n").alias("n")).orderBy("votes").collect()}
    posterior = label_model(pattern)
    few = training_groups(groups)
    few = sorted(few, key=lambda r: (r["votes"], r["counts"]))
    votes = np.array([r["votes"] for r in few]).reshape(len(few), LEXICON_VOTERS + PATTERN_VOTERS)
    x = inputs(np.array([r["counts"] for r in few], float).reshape(len(few), len(entries)), votes)
    y = np.array([posterior[tuple(r["votes"])] for r in few])
    return Model(Lexicon(entries), *train(x, y, np.array([r["weight"] for r in few], float)))


def score(df: DataFrame, model: Model, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    shared = df.sparkSession.sparkContext.broadcast((model.lexicon.entries, model.weights, model.bias))

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        entries, weights, bias = shared.value
        found = Model(Lexicon(entries), weights, bias).score(raw_texts(batch, text))
        return [pa.array(found, pa.float64()), pa.array((found >= threshold).astype(np.int32), pa.int32())]

    return append(df, [("score", T.DoubleType()), ("predicted", T.IntegerType())], columns)
