"""Substring dedup over sliding runs of sentences.

A text is cut into sentences at sentence marks and line ends; a sentence of more than
``LONG`` words is cut further at commas, colons and semicolons, and then after the word of smallest
hash in any ``LONG`` words in a row (the last of equal ones), so that the same words are cut alike
whatever stands before them and no piece has more than ``LONG`` words.  At each sentence starts one
run and ends one: the shortest ones of at least two sentences and ``MIN_WORDS`` words.
Runs are compared by a 64-bit hash of their lower-cased words.  A run is a repeat if the same run
occurs earlier: in a row of smaller id, or earlier in the same text.  Sentences that any repeat
covers are removed; the first occurrence stays.

Only (hash, id) pairs are shuffled for the global join: grouped with partial aggregation to the
smallest and largest id of each hash, then joined back (a common run's rows are split by adaptive
execution, as the other side has one row for it).  The hashes found are gathered by id, and the
texts with any are cut again from them.

Defined results: a null text stays null and a text without words stays as it is; rows that share
an id count as one document (their runs don't make each other repeats); rows of null id come
after all others, those of equal text as one document; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import Words, append, chunks, mix, raw_texts, run_hashes

LONG, MIN_WORDS = 12, 15
#: Rows of null id are ordered after the others, by a hash of their text.
_LATE = 1 << 62
_STOP, _PAUSE = (np.isin(np.arange(256), np.frombuffer(marks, np.uint8)) for marks in (b".!?", b",;:"))


def _starts(flag_after: np.ndarray, n: int) -> np.ndarray:
    """First words of the pieces, where flag_after says that a piece ends after a word."""
    return np.concatenate([[0], np.flatnonzero(flag_after[:-1]) + 1]) if n else np.zeros(0, np.int64)


def _low_words(hashes: np.ndarray, wide: np.ndarray, piece: np.ndarray, long: int) -> np.ndarray:
    """Whether a word has the smallest hash (the last of equal ones) of some ``long`` words in a row
    of its piece, where the piece is ``wide``."""
    out = np.zeros(len(hashes), bool)
    if wide.any():
        at = np.flatnonzero(wide[:len(wide) - long + 1] & (piece[:len(piece) - long + 1] == piece[long - 1:]))
        rows = np.lib.stride_tricks.sliding_window_view(mix(hashes), long)[:, ::-1]
        for a in range(0, len(at), 1 << 16):
            some = at[a:a + (1 << 16)]
            out[some + long - 1 - rows[some].argmin(1)] = True
    return out


class Sentences:
    """The sentences of several texts as ranges of words, and the runs that start or end at them."""

    def __init__(self, texts: list[bytes], long: int = LONG, min_words: int = MIN_WORDS):
        self.words = w = Words(texts)
        n = len(w)
        last = w.data[w.end - 1] if n else np.zeros(0, np.uint8)
        lines = np.concatenate([[0], np.cumsum(w.data == 10)])
        over = np.ones(n, bool)
        if n:
            over[:-1] = lines[w.start[1:]] > lines[w.end[:-1]]   # texts are joined by line ends, too
        stop = over | _STOP[last]
        for pause in (_PAUSE[last], None):
            first = _starts(stop, n)
            size = np.diff(np.append(first, n))
            wide = np.repeat(size > long, size)
            if pause is None:
                pause = _low_words(w.hash, wide, np.repeat(np.arange(len(first)), size), long)
            stop = stop | (wide & pause)
        self.first = _starts(stop, n)                            # a sentence's first word
        self.stop = np.append(self.first[1:], n)
        text = w.text
        self.text = text[self.first] if n else self.first
        m = len(self.first)
        at = np.arange(m)
        # the run from sentence i ends with sentence `to[i]`
        to = np.maximum(np.searchsorted(self.stop, self.first + min_words), at + 1)
        # and the one that ends with sentence i starts with sentence `since[i]`
        since = np.minimum(np.searchsorted(self.first, self.stop - min_words, "right") - 1, at - 1)
        both = np.unique(np.concatenate([at * m + to, since * m + at])[np.concatenate([to < m, since >= 0])])
        start, to = both // max(m, 1), both % max(m, 1)
        ok = self.text[start] == self.text[to]
        self.run, self.run_to = start[ok], to[ok]
        self.hash = run_hashes(w.hash, self.first[self.run], self.stop[self.run_to]).view(np.int64)
        self.run_text = self.text[self.run]

    def per_text(self) -> list[slice]:
        edges = np.searchsorted(self.run_text, np.arange(len(self.words.first) + 1))
        return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def repeats_inside(self) -> np.ndarray:
        """For each run whether its text has it earlier."""
        order = np.lexsort((self.run, self.hash, self.run_text))
        h, t = self.hash[order], self.run_text[order]
        out = np.zeros(len(order), bool)
        out[order[1:]] = (h[1:] == h[:-1]) & (t[1:] == t[:-1])
        return out

    def covered(self, repeat: np.ndarray) -> np.ndarray:
        """For each sentence whether a run of ``repeat`` covers it."""
        edge = np.zeros(len(self.first) + 1, np.int64)
        np.add.at(edge, self.run[repeat], 1)
        np.add.at(edge, self.run_to[repeat] + 1, -1)
        return np.cumsum(edge)[:-1] > 0


def run_hash_lists(texts: list[bytes]) -> list[tuple[list[int], bool]]:
    """For each text its distinct run hashes and whether one occurs twice."""
    out = []
    for _, some in chunks(texts):
        s = Sentences(some)
        again = s.repeats_inside()
        for part in s.per_text():
            out.append((s.hash[part][~again[part]], bool(again[part].any())))
    return out


def cut(text: bytes, repeats: np.ndarray) -> tuple[bytes, int]:
    """(the text without the sentences of repeated runs, sentences removed)."""
    s = Sentences([text])
    gone = s.covered(np.isin(s.hash, repeats) | s.repeats_inside())
    if not gone.any():
        return text, 0
    start = s.words.start[s.first]
    stop = np.append(start[1:], len(text))
    kept = [text[:start[0]], *(text[a:b] for a, b in zip(start[~gone], stop[~gone], strict=True))]
    return b"".join(kept), int(gone.sum())


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with ``text`` cut and the column ``n_removed``, the sentences cut from it."""
    def hashes(batch: pa.RecordBatch) -> list[pa.Array]:
        found = run_hash_lists(raw_texts(batch, "text"))
        sizes = np.cumsum([0] + [len(h) for h, _ in found])
        flat = np.concatenate([h for h, _ in found]) if found else np.zeros(0, np.int64)
        return [pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int64())),
                pa.array([again for _, again in found], pa.bool_())]

    late = F.xxhash64(text).bitwiseAND(F.lit(_LATE - 1)) + F.lit(_LATE)
    ident = F.coalesce(F.col(key).cast("long"), late)
    source = df.select(ident.alias("id"), F.col(text).alias("text")).filter(F.length("text") > 0)
    runs = append(source, [("runs", T.ArrayType(T.LongType(), False)), ("again", T.BooleanType())], hashes).drop("text")
    pairs = runs.select("id", F.explode("runs").alias("run"))
    shared = pairs.groupBy("run").agg(F.min("id").alias("low"), F.max("id").alias("high")).filter("low < high")
    found = pairs.join(shared.select("run", "low"), "run").filter("low < id").select("id", "run")
    inside = runs.filter("again").select("id", F.lit(None).cast("long").alias("run"))
    lists = found.unionByName(inside).groupBy("id").agg(F.collect_set("run").alias("__runs"))

    def cuts(batch: pa.RecordBatch) -> list[pa.Array]:
        marks, was = batch.column("__runs").to_pylist(), batch.column(text).cast(pa.binary()).to_pylist()
        out: list[tuple] = []
        for t, found in zip(was, marks, strict=True):
            out.append((t, 0) if found is None or not t else cut(t, np.array(found, np.int64)))
        return [pa.array([x[0] for x in out], pa.binary()).cast(pa.string()),
                pa.array([x[1] for x in out], pa.int64())]

    new = {"n_removed", "__id", "__runs"}
    base = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in new])
    joined = base.withColumn("__id", ident).join(lists.withColumnRenamed("id", "__id"), "__id", "left").drop("__id")
    out = append(joined, [("__cut", T.StringType()), ("n_removed", T.LongType())], cuts).drop("__runs")
    names = [F.col("__cut").alias(c) if c == text else F.col(f"`{c}`") for c in base.columns]
    return out.select(*names, "n_removed")
