"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds all word sequences of the normalised items (words of digits, letters and
non-ASCII characters, A-Z lower-cased).  A text's words are streamed through it; the state keeps
the longest suffix read so far that occurs in some item.  Where that length reaches WINDOW (or a
shorter item ends), the words of the match are hit, and the state names the items that hold the
window.  Runs of hit words are the spans; a text is contaminated when they cover 1/20 of it.

Before streaming, numpy finds the stretches in which every pair of neighbours is a pair of
neighbours in some item; no window lies outside these, so only they go through the automaton.

The items are a test set: their total is measured before they go to the driver.  Beyond
``MAX_ITEM_BYTES`` they are split by a hash into shards of about that size, and the texts pass one
shard's automaton after the other, which adds to the rows' hits.

Defined results: null texts and null items have no words; rows are judged one by one, so repeated
rows get equal results; rows that share an item_id are one item with the
windows of all; a null item_id is no item;
without items nothing is hit; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import ALNUM, Words, append, chunks, raw_texts, ship, written

WINDOW = 13
MAX_ITEM_BYTES = 1 << 23
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


class Automaton:
    """A suffix automaton of several word sequences."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.step: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set[int]] = {}                    # state -> items with an occurrence that ends there
        whole: dict[int, set[int]] = {}                   # state -> short items that are exactly this string
        self.names = [name for name, _ in items]
        for k, (_, seq) in enumerate(items):
            state = 0
            for word in seq:
                state = self._extend(state, word)
                ends.setdefault(state, set()).add(k)
        # states by falling length: an occurrence of a string is one of its suffixes, too
        order = sorted(range(1, len(self.length)), key=lambda v: -self.length[v])
        for v in order:
            if (up := self.link[v]) > 0 and v in ends:
                ends.setdefault(up, set()).update(ends[v])
        for k, (_, seq) in enumerate(items):
            if 0 < len(seq) < window:
                state = 0
                for word in seq:
                    state = self.step[state][word]
                whole.setdefault(state, set()).add(k)
        self.shortest = min([window, *(len(s) for _, s in items if s)])
        # what a match at a state reports: (state that holds the window, its items), short items on the way
        self.holds = [frozenset(ends.get(v, ())) if self.length[v] >= window > self.length[max(self.link[v], 0)]
                      else frozenset() for v in range(len(self.length))]
        self.short = [()] * len(self.length)
        sizes = [len(s) for _, s in items]
        for v in reversed(order):
            # a whole short item is the longest string of its state or, in a state that began
            # longer, a shorter one: told apart by its length
            own = tuple((sizes[k], k) for k in sorted(whole.get(v, ())))
            self.short[v] = own + (self.short[self.link[v]] if self.link[v] > 0 else ())
        self.up = list(range(len(self.length)))           # nearest state on the link path that holds windows
        for v in reversed(order):
            if self.length[max(self.link[v], 0)] >= window:
                self.up[v] = self.up[self.link[v]]

    def _extend(self, last: int, word: bytes) -> int:
        step, link, length = self.step, self.link, self.length
        if word in step[last]:
            q = step[last][word]
            return q if length[q] == length[last] + 1 else self._clone(last, word, q)
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in step[p]:
            step[p][word] = new
            p = link[p]
        if p >= 0:
            q = step[p][word]
            link[new] = q if length[q] == length[p] + 1 else self._clone(p, word, q)
        return new

    def _clone(self, p: int, word: bytes, q: int) -> int:
        step, link, length = self.step, self.link, self.length
        copy = len(step)
        step.append(dict(step[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        link[q] = copy
        while p >= 0 and step[p].get(word) == q:
            step[p][word] = copy
            p = link[p]
        return copy

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int], int]:
        """(hit ranges of words, items found, longest match) of one run of words."""
        step, link, length, window = self.step, self.link, self.length, self.window
        state = matched = longest = 0
        hits: list[tuple[int, int]] = []
        items: set[int] = set()
        for i, word in enumerate(words, 1):
            while state and word not in step[state]:
                state = link[state]
                matched = length[state]
            if word in step[state]:
                state = step[state][word]
                matched += 1
            if matched > longest:
                longest = matched
            if matched >= window:
                hits.append((i - matched, i))
                items |= self.holds[self.up[state]]
            for size, k in self.short[state]:
                if size <= matched:
                    hits.append((i - size, i))
                    items.add(k)
        return hits, items, longest


class Matcher:
    """The automaton with the pairs of neighbours that lead to it."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.auto = Automaton(items, window)
        pairs = []
        single = []
        for _, seq in items:
            if seq:
                h = Words([b" ".join(seq)], ALNUM).hash
                single.append(h)
                pairs.append(pair_keys(h))
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.uint64)
        self.single = np.unique(np.concatenate(single)) if single else np.zeros(0, np.uint64)

    def find(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[int], int]]:
        """For each text (words, hit spans, items, longest match)."""
        out = []
        for _, some in chunks(texts):
            w = Words(some, ALNUM)
            n, need = len(w), self.auto.shortest
            found = [(int(c), [], set(), 0) for c in w.counts]
            if n and len(self.single):
                live = np.zeros(n + 1, bool)              # live[i]: words i-1 and i may be neighbours in an item
                live[1:n] = _member(pair_keys(w.hash), self.pairs)
                live[w.first[w.counts > 0]] = False
                cut = np.flatnonzero(~live)               # runs are [cut[j], cut[j+1])
                size = np.diff(cut)
                for a, m in zip(cut[:-1][size >= need].tolist(), size[size >= need].tolist(), strict=True):
                    if m == 1 and w.hash[a] not in self.single:
                        continue
                    t = int(np.searchsorted(w.first, a, "right")) - 1
                    run = [w.data[s:e].tobytes() for s, e in zip(w.start[a:a + m], w.end[a:a + m], strict=True)]
                    hits, items, longest = self.auto.stream(run)
                    at = a - int(w.first[t])
                    c, spans, had, most = found[t]
                    found[t] = (c, spans + [(x + at, y + at) for x, y in hits], had | items, max(most, longest))
            out += [(c, merge(spans), items, most) for c, spans, items, most in found]
        return out


def pair_keys(h: np.ndarray) -> np.ndarray:
    return h[:-1] * np.uint64(0x9E3779B97F4A7C15) + (h[1:] ^ (h[1:] >> np.uint64(29)))


def _member(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(known, keys)
    at[at == len(known)] = 0
    return known[at] == keys


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def item_shards(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in shards of about MAX_ITEM_BYTES, one at a time, in the order of their ids."""
    rows = benchmark.filter(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"))
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    parts = max(1, -(-total // MAX_ITEM_BYTES))
    for part in range(parts):
        some = rows.filter(F.pmod(F.xxhash64("k", "t"), F.lit(parts)) == part).distinct().orderBy("k", "t").collect()
        yield [(r["k"], words_of((r["t"] or "").encode("utf-8", "replace"))) for r in some]


_SPAN = pa.struct([("first", pa.int64()), ("stop", pa.int64())])
_STATE = ["n_words", "longest", "items", "spans"]


def _stream(df: DataFrame, items: list[tuple[str, list[bytes]]], text: str, window: int, later: bool) -> DataFrame:
    """``df`` with _STATE; of a ``later`` shard, added to what the columns hold."""
    shared = df.sparkSession.sparkContext.broadcast(Matcher(items, window))
    if later:
        df = df.withColumnsRenamed({c: f"__{c}" for c in _STATE})

    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        matcher = shared.value
        found = matcher.find(raw_texts(batch, text))
        words, spans = [f[0] for f in found], [f[1] for f in found]
        names, most = [{matcher.auto.names[k] for k in f[2]} for f in found], [f[3] for f in found]
        if later:
            old = [batch.column(f"__{c}").to_pylist() for c in _STATE[1:]]
            most = [max(x) for x in zip(most, old[0], strict=True)]
            names = [x.union(y) for x, y in zip(names, old[1], strict=True)]
            spans = [merge(x + [(s["first"], s["stop"]) for s in y]) for x, y in zip(spans, old[2], strict=True)]
        return [pa.array(words, pa.int64()), pa.array(most, pa.int64()), pa.array([sorted(x) for x in names], pa.list_(pa.string())),
                pa.array([[{"first": a, "stop": b} for a, b in s] for s in spans], pa.list_(_SPAN))]

    span = T.StructType([T.StructField("first", T.LongType()), T.StructField("stop", T.LongType())])
    types = [T.LongType(), T.LongType(), T.ArrayType(T.StringType()), T.ArrayType(span)]
    return append(df, list(zip(_STATE, types, strict=True)), columns).drop(*[f"__{c}" for c in _STATE])


def mark(df: DataFrame, benchmark: DataFrame, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with n_words, longest (longest match), items (ids as strings, sorted), spans (word
    ranges), n_hit, n_items, contaminated.  Between shards of items the rows are a written table."""
    ship(df.sparkSession)
    for number, items in enumerate(item_shards(benchmark)):
        df = _stream(written(df, "marks") if number else df, items, text, window, number > 0)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["first"])
    df = df.select(*[f"`{c}`" for c in df.columns if c.lower() not in ("n_hit", "n_items", "contaminated")])
    return (df.withColumn("n_hit", hit).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def remove_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """``text`` of marked rows without the words of their spans (the separators between stay)."""
    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        out = []
        for raw, spans in zip(batch.column(text).cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist(), strict=True):
            if raw and spans:
                w = Words([raw], ALNUM)
                parts, at = [], 0
                for s in spans:
                    parts.append(raw[at:w.start[s["first"]]])
                    at = int(w.end[s["stop"] - 1])
                raw = b"".join([*parts, raw[at:]])
            out.append(raw)
        return [pa.array(out, pa.binary()).cast(pa.string())]

    order = df.columns
    return append(df, [("__clean", T.StringType())], columns).drop(text).withColumnRenamed("__clean", text).select(*order)

