"""Target-distribution importance resampling: the rows most like a target table, drawn without replacement.

Features are the runs of one to GRAMS consecutive words, hashed by CRC-32 into BUCKETS buckets.
Two bucket arrays (the corpus and the target) give each bucket an integer gain, the log ratio of
its smoothed shares; a row's weight is the sum of its features' gains.  Weight plus a Gumbel
number fixed by the row's id is the score: the k highest scores are a draw of k rows without
replacement in proportion to exp(weight / 1000).

The k-th key is found by a distributed quickselect: each round takes a few random keys among
those still possible as pivots, counts exactly how many keys lie between and on them (one pass
over the keys, at most 2 * PIVOTS + 1 counts to the driver) and keeps the part with the k-th.
Only the rows up to that key are sorted and ranked.

Defined results: a null text has no words; a row without features has weight 0; rows with fewer
than ``min_words`` words are never drawn.  The key is (score, highest first; id, smallest first,
nulls last; place in the written table), so repeated rows are drawn one by one, and a null id
draws the number of the empty id.  An empty corpus gives an empty result; an empty target makes
all gains those of unseen buckets.  Input columns named like an added one are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import ALNUM, JOIN_BYTES, Words, append, bound_batches, chunks, raw_texts, ship, written
from plinth.operators.rank import global_rank

BUCKETS, GRAMS, PIVOTS = 10_000, 3, 15
ADDED = ["n_words", "n_features", "weight", "score", "rank"]
_WORD, _BREAK = re.compile(rb"[0-9A-Za-z\x80-\xff]+"), re.compile(rb"[^0-9A-Za-z\x80-\xff]")
#: Words of more bytes than this are hashed one by one.
_LONG = 48


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


class _Feeder:
    """Feeds the words of a block to CRC registers, one byte position of all words at a time."""

    def __init__(self, w: Words):
        self.w, size = w, w.end - w.start
        self.order = np.argsort(-size, kind="stable")
        self.start, ranked = w.start[self.order], -size[self.order]
        self.alive = np.searchsorted(ranked, -np.arange(min(int(-ranked[0]), _LONG)), side="left")
        self.n_long = int(np.searchsorted(ranked, -_LONG, side="left"))

    def feed(self, register: np.ndarray) -> np.ndarray:
        """For each word the register after its bytes."""
        r, data = register[self.order], self.w.data
        for j, n in enumerate(self.alive):
            r[:n] = _CRC[(r[:n] ^ data[self.start[:n] + j]) & 255] ^ (r[:n] >> 8)
        for i in range(self.n_long):
            at = self.order[i]
            rest = data[self.w.start[at] + _LONG:self.w.end[at]].tobytes()
            r[i] = zlib.crc32(rest, int(r[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
        out = np.empty_like(r)
        out[self.order] = r
        return out


def _space(register: np.ndarray) -> np.ndarray:
    return _CRC[(register ^ np.uint32(32)) & 255] ^ (register >> 8)


def _block_features(texts: list[bytes], skip: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, bucket of each feature); the first ``skip`` words
    of a text are there for the runs that end after them."""
    w = Words(texts, ALNUM)
    counts = np.maximum(w.counts - skip, 0)
    if not len(w):
        none = np.zeros(0, np.int64)
        return counts, none, none
    feeder, text = _Feeder(w), w.text
    place = np.arange(len(w)) - w.first[text]                              # of the word in its text
    register = np.full(len(w), 0xFFFFFFFF, np.uint32)
    owners, buckets = [], []
    for gram in range(GRAMS):
        register = feeder.feed(register)
        ok = place >= max(gram, skip)
        owners.append(text[ok])
        buckets.append((register[ok] ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % BUCKETS)
        register = _space(np.concatenate([register[:1], register[:-1]]))   # of the run that ends a word earlier
    return counts, np.concatenate(owners), np.concatenate(buckets)


def _blocks(text: bytes) -> Iterator[tuple[bytes, int]]:
    """(block, words carried over): a long text cut between words, with the GRAMS - 1 words before."""
    at, head, carried = 0, b"", 0
    while at < len(text):
        cut = _BREAK.search(text, min(len(text), at + JOIN_BYTES))
        stop = cut.start() if cut else len(text)
        block = head + text[at:stop]
        yield block, carried
        last = _WORD.findall(block)[-(GRAMS - 1):]
        at, head, carried = stop, b" ".join(last) + b" ", len(last)


def features(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, words of each text, text of each feature, its bucket) for runs of texts; the parts
    of a long text come one after the other."""
    for first, some in chunks(texts):
        if len(some) == 1 and len(some[0]) > JOIN_BYTES:
            for block, carried in _blocks(some[0]):
                yield first, *_block_features([block], carried)
        else:
            yield first, *_block_features(some, 0)


def bucket_counts(df: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all rows lie in each bucket: one array a task, summed by bucket."""
    ship(df.sparkSession)
    bound_batches(df.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, _, bucket in features(raw_texts(batch, "text")):
                total += np.bincount(bucket, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    parts = df.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():    # at most BUCKETS rows
        out[bucket] = n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(((t + 1) / (T + BUCKETS)) / ((s + 1) / (S + BUCKETS)))) of each bucket."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(df: DataFrame, gain: np.ndarray, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and ``weight``."""
    sent = df.sparkSession.sparkContext.broadcast(gain)                    # BUCKETS numbers

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        texts, table = raw_texts(batch, text), sent.value.astype(float)
        words, total = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        n = np.zeros(len(texts), np.int64)
        for first, counts, owner, bucket in features(texts):
            part = slice(first, first + len(counts))
            words[part] += counts
            n[part] += np.bincount(owner, minlength=len(counts))
            total[part] += np.bincount(owner, table[bucket], len(counts))  # whole numbers below 2**53
        return [pa.array(a.astype(np.int64)) for a in (words, n, total)]

    names = [(c, T.LongType()) for c in ADDED[:3]]
    return append(df, names, columns, leave=() if keep_text else [text])


def gumbel(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256("seed:key")."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _literal(values: tuple, fields: list[T.StructField]) -> Column:
    return F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(values, fields, strict=True)])


def kth_key(keys: DataFrame, k: int, seed: int = 42) -> tuple:
    """The k-th smallest row (k from 1) of ``keys``, unique rows without nulls compared column by column.

    Each round keeps the keys between two neighbouring pivots; with at most PIVOTS keys left, all
    are pivots and the k-th is one of them.
    """
    fields = keys.schema.fields
    key = F.struct(*[F.col(f.name) for f in fields])
    lead = F.col(fields[0].name)
    low = high = None
    for turn in range(200):
        part = keys
        if low is not None:
            part = part.filter((lead >= F.lit(low[0])) & (key > _literal(low, fields)))
        if high is not None:
            part = part.filter((lead <= F.lit(high[0])) & (key < _literal(high, fields)))
        drawn = part.orderBy(F.xxhash64(F.lit(seed + turn), *[F.col(f.name) for f in fields])).limit(PIVOTS)
        pivots = sorted(tuple(r) for r in drawn.collect())
        marks = [_literal(p, fields) for p in pivots]

        def side(a: int, b: int, marks=marks) -> Column:
            """2 i below pivot i (and above the last), 2 i + 1 on it, by binary search."""
            if a == b:
                return F.lit(2 * a)
            m = (a + b) // 2
            return F.when(key < marks[m], side(a, m)).when(key == marks[m], F.lit(2 * m + 1)).otherwise(side(m + 1, b))

        counts = dict(part.groupBy(side(0, len(pivots)).alias("side")).count().collect())
        for s in range(2 * len(pivots) + 1):
            n = counts.get(s, 0)
            if k <= n:
                break
            k -= n
        else:
            raise ValueError("fewer keys than k")
        if s % 2:
            return pivots[s // 2]
        low = pivots[s // 2 - 1] if s else low
        high = pivots[s // 2] if s // 2 < len(pivots) else high
    raise RuntimeError("the keys are not unique")


def resample(df: DataFrame, target: DataFrame, percent: int = 5, min_words: int = 20, seed: int = 42,
             key: str = "doc_id", text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ADDED: ``rank`` is 1, 2, ... for the floor(percent / 100) of the rows with ``min_words``
    words that are drawn, null for the others."""
    gain = gains(bucket_counts(df, text), bucket_counts(target, text))
    old = [c for c in df.columns if c.lower() not in ADDED]
    scored = weigh(df.select(*[f"`{c}`" for c in old]), gain, text, keep_text)
    scored = written(scored.withColumn("score", F.col("weight") + gumbel(F.col(f"`{key}`"), seed))
                     .withColumn("__at", F.monotonically_increasing_id()), "resample")
    blank = F.lit("" if isinstance(df.schema[key].dataType, T.StringType) else 0).cast(df.schema[key].dataType)
    scored = scored.withColumns({
        "__down": -F.col("score"), "__none": F.col(f"`{key}`").isNull(), "__key": F.coalesce(F.col(f"`{key}`"), blank)})
    order = ["__down", "__none", "__key", "__at"]
    out = [*[f"`{c}`" for c in scored.columns if not c.startswith("__")], "rank"]
    able = F.col("n_words") >= min_words
    k = scored.filter(able).count() * percent // 100
    none = F.lit(None).cast("long")
    if not k:
        return scored.withColumn("rank", none).select(*out)
    last = _literal(kth_key(scored.filter(able).select(*order), k, seed), scored.select(*order).schema.fields)
    drawn = able & (F.struct(*order) <= last)
    ranked = global_rank(scored.filter(drawn), order, "rank")
    return ranked.select(*out).unionByName(scored.filter(~drawn).withColumn("rank", none).select(*out))
