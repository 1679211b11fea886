"""Language-model scores by masked pseudo-likelihood.

A window network predicts each word from the WINDOW words on either side of it: the positions'
embeddings are summed, squashed, and fed to a two-level softmax (a class of words, then the word in
it), so a probability costs two short rows instead of one over the vocabulary.  A text's score is the
sum of the log-probabilities of all its words.

The network's symbols are the most frequent words of the whole corpus, by hash, and one for all
others.  Which of the others a word is, has its probability from the table of all word counts, which
grows with the corpus and is joined by word hash (never collected): (n + distinct * spelling) /
(occurrences + distinct), so an unseen word (n = 0) gets the probability of its spelling, from counts
of pairs of bytes in such words.  Training goes over all texts: every task starts from the same weights, takes stochastic gradient steps (in numpy) on
one word in MASK of its texts, chosen by a hash, and gives its weights; their mean, weighted by
words and summed in two levels of shuffles, is the network.

Defined results: a null or blank text has no words and log-probability 0 (mean null); repeated
rows get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import SPACED, Words, append, chunks, mix, raw_texts, ship, written

WINDOW, DIM, CLASSES, PER_CLASS, MASK = 2, 24, 32, 64, 7
VOCABULARY = CLASSES * PER_CLASS
#: Symbols: 0 a rare word, then words by rank; the last one stands beyond a text's ends.
RARE, EDGE = 0, VOCABULARY - 1
_BATCH, _FLUSH, _BLOCK, _SPREAD = 8192, 1 << 20, 1 << 14, 16
#: Log-probabilities are summed as integers of this many parts, so the order of rows has no effect.
_PARTS = 1 << 24
_SHAPES = {"embed": (2 * WINDOW, VOCABULARY, DIM), "out": (DIM, CLASSES), "out_bias": (CLASSES,),
           "word": (CLASSES, DIM, PER_CLASS), "word_bias": (CLASSES, PER_CLASS)}


def count_words(df: DataFrame, text: str = "text") -> DataFrame:
    """(word hash, occurrences) over all texts; each task sums its own first."""
    ship(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            key, at = np.unique(np.concatenate([s[0] for s in seen]), return_inverse=True)
            total = np.bincount(at, np.concatenate([s[1] for s in seen]), minlength=len(key)).astype(np.int64)
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(total)], names=["word", "n"])

        for batch in batches:
            for _, some in chunks(raw_texts(batch, text)):
                seen.append(np.unique(Words(some).hash, return_counts=True))
                if sum(len(s[0]) for s in seen) > _FLUSH:
                    yield flush()
        if seen:
            yield flush()

    return df.select(text).mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Net:
    """The network's weights, its scores and its training steps."""

    def __init__(self, words: np.ndarray, weights: dict[str, np.ndarray] | None = None, pairs: np.ndarray | None = None):
        self.words = words                                         # hashes by rank
        self.pairs = np.zeros((256, 256)) if pairs is None else pairs   # bytes of rare words; 32 for their ends
        order = np.argsort(words)
        self.known, self.symbol = words[order], order + 1
        if weights is None:
            rng = np.random.default_rng(3)
            weights = {k: (rng.normal(0, 0.1, s) if len(s) > 1 and k != "word_bias" else np.zeros(s)).astype(np.float32) for k, s in _SHAPES.items()}
        self.w = weights

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.symbol[at], RARE)

    @staticmethod
    def contexts(words: Words, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The symbols around the positions ``at``."""
        text = words.text[at]
        out = np.empty((len(at), 2 * WINDOW), np.int64)
        for k, step in enumerate((*range(-WINDOW, 0), *range(1, WINDOW + 1))):
            near = at + step
            inside = (near >= words.first[text]) & (near < words.stop[text])
            out[:, k] = np.where(inside, symbols[np.where(inside, near, 0)], EDGE)
        return out

    def hidden(self, around: np.ndarray) -> np.ndarray:
        total = self.w["embed"][0][around[:, 0]]
        for k in range(1, 2 * WINDOW):
            total = total + self.w["embed"][k][around[:, k]]
        return np.tanh(total)

    def log_probabilities(self, around: np.ndarray, target: np.ndarray) -> np.ndarray:
        h = self.hidden(around)
        cls, place = target % CLASSES, target // CLASSES
        out = _log_softmax(h @ self.w["out"] + self.w["out_bias"])[np.arange(len(h)), cls].astype(np.float64)
        for c, rows in _by_class(cls):
            out[rows] += _log_softmax(h[rows] @ self.w["word"][c] + self.w["word_bias"][c])[np.arange(len(rows)), place[rows]]
        return out

    def score(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(words, log pseudo-likelihood) of each text."""
        counts, total = [], []
        for _, some in chunks(texts):
            words = Words(some)
            symbols = self.symbols(words.hash)
            logs = np.zeros(len(words))
            for a in range(0, len(words), 2 * _BATCH):
                at = np.arange(a, min(len(words), a + 2 * _BATCH))
                logs[at] = self.log_probabilities(self.contexts(words, symbols, at), symbols[at])
            counts.append(words.counts)
            total.append(words.sums(logs))
        return (np.concatenate(counts), np.concatenate(total)) if counts else (np.zeros(0, np.int64), np.zeros(0))

    def rare(self, texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its distinct rare words (hashes), their occurrences and log-probabilities of spelling."""
        spell = np.log((self.pairs + 1 / 256) / (self.pairs.sum(1, keepdims=True) + 1)).ravel()
        spell = np.round(spell * _PARTS).astype(np.int64)
        out = []
        for _, some in chunks(texts):
            words = Words(some)
            at = np.flatnonzero(self.symbols(words.hash) == RARE)
            total = np.concatenate([[0], np.cumsum(spell[_pairs(words)])])
            logs = (total[words.end[at] + 1] - total[words.start[at]]) / _PARTS
            edges = np.searchsorted(at, np.append(words.first, len(words)))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                key, first, times = np.unique(words.hash[at[a:b]], return_index=True, return_counts=True)
                out.append((key.view(np.int64), times, logs[a:b][first]))
        return out

    def step(self, around: np.ndarray, target: np.ndarray, pace: dict[str, np.ndarray], rate: float = 0.1) -> None:
        """One Adagrad step on the mean loss of a batch."""
        n, h = len(target), self.hidden(around)
        cls, place = target % CLASSES, target // CLASSES
        error = np.exp(_log_softmax(h @ self.w["out"] + self.w["out_bias"]))
        error[np.arange(n), cls] -= 1
        error /= n
        back = error @ self.w["out"].T
        grads = {"out": h.T @ error, "out_bias": error.sum(0), "word": np.zeros(_SHAPES["word"], np.float32),
                 "word_bias": np.zeros(_SHAPES["word_bias"], np.float32)}
        for c, rows in _by_class(cls):
            e = np.exp(_log_softmax(h[rows] @ self.w["word"][c] + self.w["word_bias"][c]))
            e[np.arange(len(rows)), place[rows]] -= 1
            e /= n
            back[rows] += e @ self.w["word"][c].T
            grads["word"][c], grads["word_bias"][c] = h[rows].T @ e, e.sum(0)
        back *= 1 - h * h
        for k, g in grads.items():
            pace[k] += g * g
            self.w[k] -= rate * g / np.sqrt(pace[k] + 1e-10)
        for k in range(2 * WINDOW):
            order = np.argsort(around[:, k], kind="stable")
            ids, first = np.unique(around[order, k], return_index=True)
            g = np.add.reduceat(back[order], first)
            pace["embed"][k][ids] += g * g
            self.w["embed"][k][ids] -= rate * g / np.sqrt(pace["embed"][k][ids] + 1e-10)

    def train(self, batches: Iterable[list[bytes]]) -> int:
        """Steps over the masked words of all texts; gives the number of these words."""
        pace = {k: np.full(s, 1e-8, np.float32) for k, s in _SHAPES.items()}
        seen, kept = 0, []
        for texts in batches:
            for _, some in chunks(texts):
                words = Words(some)
                if not len(words):
                    continue
                symbols, at = self.symbols(words.hash), np.arange(len(words))
                inside = np.zeros(len(words.data) + 2, np.int64)
                np.add.at(inside, words.start[symbols == RARE], 1)
                np.add.at(inside, words.end[symbols == RARE] + 1, -1)
                spelt = _pairs(words)[np.cumsum(inside)[:-1] > 0]
                self.pairs += np.bincount(spelt, minlength=1 << 16).reshape(256, 256)
                offset = (at - words.first[words.text]).astype(np.uint64)
                at = at[mix(words.hash ^ (offset << np.uint64(40))) % np.uint64(MASK) == 0]
                kept.append((self.contexts(words, symbols, at), symbols[at]))
                seen += len(at)
                if sum(len(t) for _, t in kept) >= _BATCH:
                    self._steps(kept, pace)
        self._steps(kept, pace)
        return seen

    def _steps(self, kept: list, pace: dict[str, np.ndarray]) -> None:
        if kept:
            around, target = np.concatenate([k[0] for k in kept]), np.concatenate([k[1] for k in kept])
            kept.clear()
            for a in range(0, len(target), _BATCH // 8):
                self.step(around[a:a + _BATCH // 8], target[a:a + _BATCH // 8], pace)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.w[k].ravel() for k in _SHAPES])

    @classmethod
    def of(cls, words: np.ndarray, flat: np.ndarray, pairs: np.ndarray) -> Net:
        weights, at = {}, 0
        for k, shape in _SHAPES.items():
            size = int(np.prod(shape))
            weights[k] = flat[at:at + size].reshape(shape).astype(np.float32)
            at += size
        return cls(words, weights, pairs)


def _pairs(words: Words) -> np.ndarray:
    """For each byte of the data, and for the end, 256 * (the byte before it) + itself; white space is 32."""
    data = np.full(len(words.data) + 2, 32, np.int64)
    data[1:-1] = np.where(SPACED[words.data], words.data, 32)
    return data[:-1] * 256 + data[1:]


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def _by_class(cls: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(cls, kind="stable")
    edge = np.searchsorted(cls[order], np.arange(CLASSES + 1))
    for c in range(CLASSES):
        if edge[c] < edge[c + 1]:
            yield c, order[edge[c]:edge[c + 1]]


def _add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the value blocks of each key; holds one block for each key of the task."""
    total: dict[tuple, list] = {}
    for batch in batches:
        for block, part, n, values in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            new = np.frombuffer(values, np.float64)
            if (block, part) in total:
                total[block, part][0] += n
                total[block, part][1] += new
            else:
                total[block, part] = [n, new.copy()]
    for (block, part), (n, values) in total.items():
        yield _block(block, part, n, values)


def _block(block: int, part: int, n: int, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([part], pa.int32()), pa.array([n], pa.int64()),
                                       pa.array([values.tobytes()], pa.binary())], names=["block", "part", "n", "sums"])


def fit(df: DataFrame, text: str = "text", counts: DataFrame | None = None) -> Net:
    """The network; ``counts`` is the table of ``count_words``, if it is there already."""
    spark = df.sparkSession
    counts = count_words(df, text) if counts is None else counts
    top = counts.orderBy(F.desc("n"), "word").limit(VOCABULARY - 2).collect()
    words = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    shared = spark.sparkContext.broadcast(words)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        net = Net(shared.value)
        seen = net.train(raw_texts(b, text) for b in batches)
        if seen:
            flat = np.concatenate([net.flat().astype(np.float64) * seen, net.pairs.ravel()])
            for k in range(0, len(flat), _BLOCK):
                yield _block(k // _BLOCK, TaskContext.get().partitionId() % _SPREAD, seen, flat[k:k + _BLOCK])

    schema = "block int, part int, n long, sums binary"
    parts = df.select(text).mapInArrow(run, schema)
    summed = parts.repartition("block", "part").mapInArrow(_add_up, schema)
    summed = summed.withColumn("part", F.lit(0)).repartition("block").mapInArrow(_add_up, schema)
    blocks = sorted((r["block"], r["n"], r["sums"]) for r in summed.collect())
    if not blocks:
        return Net(words)
    flat, size = np.concatenate([np.frombuffer(s, np.float64) for _, _, s in blocks]), 1 << 16
    return Net.of(words, flat[:-size] / blocks[0][1], flat[-size:].reshape(256, 256))


def score(df: DataFrame, net: Net, text: str = "text") -> DataFrame:
    """``df`` with n_words, log_likelihood and mean_log (for each word; null without words), by the
    network alone: a rare word counts as the symbol of all of them."""
    shared = df.sparkSession.sparkContext.broadcast((net.words, net.w))

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        n, total = Net(*shared.value).score(raw_texts(batch, text))
        mean = np.divide(total, n, out=np.zeros(len(n)), where=n > 0)
        return [pa.array(n, pa.int64()), pa.array(total), pa.array(mean, mask=n == 0)]

    return append(df, [("n_words", T.LongType()), ("log_likelihood", T.DoubleType()), ("mean_log", T.DoubleType())], columns)


def score_words(df: DataFrame, net: Net, counts: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with the columns of ``score`` where each rare word has its own probability.

    Only (row, word) pairs of rare words are shuffled, to the word's count and back to the row.
    """
    known = counts.filter(~F.col("word").isin(net.words.view(np.int64).tolist())) if len(net.words) else counts
    tail = known.agg(F.count("*").alias("kinds"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    kinds, total = max(tail["kinds"], 1), tail["n"]
    shared = df.sparkSession.sparkContext.broadcast((net.words, net.w, net.pairs))
    pair = T.StructType([T.StructField("word", T.LongType()), T.StructField("times", T.IntegerType()), T.StructField("spelling", T.DoubleType())])

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        model, texts = Net(*shared.value), raw_texts(batch, text)
        n, logs = model.score(texts)
        found = model.rare(texts)
        edges = np.cumsum([0] + [len(f[0]) for f in found])
        flat = [np.concatenate([f[k] for f in found]) if found else np.zeros(0) for k in range(3)]
        pairs = pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(flat, (pa.int64(), pa.int32(), pa.float64()), strict=True)],
                                           names=["word", "times", "spelling"])
        return [pa.array(n, pa.int64()), pa.array(logs), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pairs)]

    own = {"n_words", "log_likelihood", "mean_log", "__row", "__rare"}
    rows = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in own], F.monotonically_increasing_id().alias("__row"))
    rows = written(append(rows, [("n_words", T.LongType()), ("log_likelihood", T.DoubleType()), ("__rare", T.ArrayType(pair))], columns, leave=[text]), "rare")
    found = rows.select("__row", F.inline("__rare")).join(counts, "word", "left")
    log = F.log((F.coalesce(F.col("n"), F.lit(0)) + kinds * F.exp("spelling")) / (total + kinds))
    # a spelling so unlikely that its probability is 0 as a double
    log = F.when(F.col("n").isNull(), F.col("spelling") + F.lit(float(np.log(kinds / (total + kinds))))).otherwise(log)
    sums = found.groupBy("__row").agg(F.sum(F.round(log * _PARTS).cast("long") * F.col("times")).alias("__log"))
    both = rows.drop("__rare").join(sums, "__row", "left")
    both = both.withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce(F.col("__log"), F.lit(0)) / _PARTS)
    mean = F.when(F.col("n_words") > 0, F.col("log_likelihood") / F.col("n_words"))
    return both.drop("__row", "__log").withColumn("mean_log", mean)
