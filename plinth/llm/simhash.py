"""SimHash near-duplicates: exact Hamming search over vantage-point trees.

1. One fingerprint per text (majority bits of the XXH64 of its word shingles).
2. Equal fingerprints collapse to one point with its smallest id (partial aggregation, so a group
   of copies of any size is one row after the map side).
3. Two points within ``d`` bits agree within d // 2 bits on one of their two halves.  For each
   half a vantage-point tree, built from a sample of points, deals all points to shards: a point
   goes left when its distance to the vantage point is at most mu, and right when it is more than
   mu - radius; so the left points whose ball crosses the boundary are also looked up on the
   right, and by the triangle inequality no close pair is separated.  A sample region that one
   half cannot split is split on the whole fingerprint with the whole radius.
4. Each shard goes on with the same recursion down to small leaves, where all distances are
   taken, and gives its links as stars (point, smallest point of its local component): at most
   one row per point, however dense a group of near copies is.
5. Alternating large-star / small-star steps join the stars to components; each round is a
   written table in the shared folder.

Only the tree (bounded by ``MAX_SHARDS`` vantage points for each half) is on the driver.

Defined results: a null, empty or blank text has fingerprint zero, linked like any other; rows of
null id take part, and a component without any id has a null component_id; repeated rows give
repeated rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.llm.common import append, raw_texts, ship, written

FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
HALVES = (np.uint64(0x00000000FFFFFFFF), np.uint64(0xFFFFFFFF00000000))
#: Points a shard should hold, sample points of a shard, and shards of a half at most.
SHARD, SAMPLE, MAX_SHARDS = 2048, 32, 1 << 16
_LEAF, _PIECE = 128, 1 << 15


def fingerprint(text: bytes, shingle: int = 3) -> int:
    import xxhash
    words = text.lower().split()                      # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.array([len(w) + 1 for w in words])
    end = np.cumsum(size) - 1
    start = end + 1 - size
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    pairs = zip(start[:n].tolist(), end[k - 1:].tolist(), strict=True)
    ones, todo = np.zeros(64, np.int64), [digest(joined[a:b], 42) for a, b in pairs]
    for at in range(0, n, _PIECE):
        h = np.array(todo[at:at + _PIECE], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def with_fingerprint(df: DataFrame, text: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """``df`` with the fingerprint as a signed long."""
    def columns(batch: pa.RecordBatch) -> list[pa.Array]:
        found = np.array([fingerprint(t, shingle) for t in raw_texts(batch, text)], np.uint64)
        return [pa.array(found.view(np.int64), pa.int64())]

    return append(df, [(name, T.LongType())], columns)


# Vantage-point trees ---------------------------------------------------------------------------

def _distance(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask)


def _choose(points: np.ndarray, mask: np.uint64, radius: int, rng) -> tuple | None:
    """(vantage, mu) whose larger side is the smallest of a few tries; None if nothing splits well."""
    best, n = None, len(points)
    for v in points[rng.integers(0, n, 6)]:
        below = np.cumsum(np.bincount(_distance(points, v, mask), minlength=65))
        mu = np.arange(65)
        left, right = below, n - np.where(mu >= radius, below[np.maximum(mu - radius, 0)], 0)
        cost = np.maximum(left, right)
        k = int(cost.argmin())
        if best is None or cost[k] < best[0]:
            best = (int(cost[k]), v, k)
    return best[1:] if best and best[0] <= 0.9 * n else None


def _split(points: np.ndarray, node: tuple) -> tuple[np.ndarray, np.ndarray]:
    v, mu, mask, radius = node
    d = _distance(points, v, mask).astype(np.int64)
    return points[d <= mu], points[d > mu - radius]


def _node(points: np.ndarray, mask: np.uint64, radius: int, whole: int, rng) -> tuple | None:
    for m, r in ((mask, radius), (FULL, whole)):
        if found := _choose(points, m, r, rng):
            return (*found, m, r)
    return None


class Tree:
    """A vantage-point tree over a sample; its leaves are numbered shards."""

    def __init__(self, sample: np.ndarray, mask: np.uint64, distance: int, leaf: int, first: int):
        self.nodes: list[tuple | int] = []            # (vantage, mu, mask, radius, left, right) or a shard
        self.next = first
        rng = np.random.default_rng(1)
        todo = [(sample, -1, 0)]
        while todo:
            points, parent, side = todo.pop()
            me = len(self.nodes)
            if parent >= 0:
                self.nodes[parent][4 + side] = me
            # a point whose half can't be told apart any more goes on by the whole fingerprint
            node = _node(points, mask, distance // 2, distance, rng) if len(points) > leaf else None
            if node is None:
                self.nodes.append(self.next)
                self.next += 1
                continue
            self.nodes.append([*node, -1, -1])
            a, b = _split(points, node)
            todo += [(b, me, 1), (a, me, 0)]

    def deal(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        todo = [(0, points)]
        while todo:
            me, some = todo.pop()
            if not len(some):
                continue
            node = self.nodes[me]
            if isinstance(node, int):
                yield node, some
            else:
                a, b = _split(some, tuple(node[:4]))
                todo += [(node[5], b), (node[4], a)]


def _near(points: np.ndarray, distance: int) -> np.ndarray:
    """For each point whether another one is near."""
    out = np.zeros(len(points), bool)
    for at in range(0, len(points), 256):
        near = np.bitwise_count(points[at:at + 256, None] ^ points[None, :]) <= distance
        out[at:at + 256] = near.sum(1) > 1
    return out


def _grow(points: np.ndarray, distance: int) -> Iterator[np.ndarray]:
    """The components of a leaf; every point is expanded once."""
    rest = points
    while len(rest):
        members, front, rest = [rest[:1]], rest[:1], rest[1:]
        while len(front) and len(rest):
            near = (np.bitwise_count(front[:256, None] ^ rest[None, :]) <= distance).any(0)
            new, rest = rest[near], rest[~near]
            members.append(new)
            front = np.concatenate([front[256:], new])
        yield np.concatenate(members)


def local_stars(points: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(point, smallest point of its component) for the distinct points that have a near one."""
    points = np.unique(points)
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    rng = np.random.default_rng(2)
    todo = [(points, m, distance // 2) for m in HALVES]
    while todo:
        some, mask, radius = todo.pop()
        node = _node(some, mask, radius, distance, rng) if len(some) > _LEAF else None
        if node is not None:
            todo += [(part, mask, radius) for part in _split(some, node)]
            continue
        some = some[_near(some, distance)]
        for group in _grow(some, distance):
            roots = {root(int(x)) for x in group}
            low = min(roots)
            for r in roots:
                parent[r] = low
    a = np.array(list(parent), np.uint64)
    b = np.array([root(int(x)) for x in a], np.uint64)
    return a[a != b], b[a != b]


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node that isn't its component's smallest one, and that one; from links (a, b).

    Ends when a round changes nothing.  The joins are ordinary sort-merge joins, whose large
    partitions adaptive execution splits.
    """
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    state = None
    edges = written(edges.select("a", "b").filter("a != b").distinct(), "stars")
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges
        state = now
        both = edges.select(F.explode(F.array(pair(F.col("a"), F.col("b")), pair(F.col("b"), F.col("a")))).alias("e")).select("e.*")
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(pair(F.col("b"), F.col("m")), pair(F.col("a"), F.col("m")))).alias("e"))
                 .select("e.*").filter("a != b").distinct())
        edges = written(small, "stars")


def links(points: DataFrame, distance: int = 3, fp: str = "fp") -> DataFrame:
    """(a, b): stars that connect all points within ``distance`` bits; ``points`` are distinct."""
    spark = points.sparkSession
    ship(spark)
    n = points.count()
    shards = min(MAX_SHARDS, -(-n // SHARD))
    sample = np.zeros(0, np.uint64)
    if shards > 1:
        rows = points.select(fp).sample(min(1.0, shards * SAMPLE / n), seed=7).limit(2 * MAX_SHARDS * SAMPLE).collect()
        sample = np.array([r[0] for r in rows], np.int64).view(np.uint64)
    trees: list[Tree] = []
    for mask in HALVES:
        trees.append(Tree(np.sort(sample), mask, distance, SAMPLE, trees[-1].next if trees else 0))
    shared = spark.sparkContext.broadcast(trees)

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for tree in shared.value:
                for shard, some in tree.deal(found):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), shard, np.int32)), pa.array(some.view(np.int64))], names=["shard", "fp"])

    def search(group: pd.DataFrame) -> pd.DataFrame:
        a, b = local_stars(group["fp"].to_numpy(np.int64).view(np.uint64), distance)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = points.select(F.col(fp).alias("fp")).mapInArrow(deal, "shard int, fp long")
    return dealt.groupBy("shard").applyInPandas(search, "a long, b long")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                    distance: int = 3) -> DataFrame:
    """One row per row of ``df``: key, ``fp`` (signed), ``group`` (smallest linked fingerprint),
    ``component_id`` (smallest key of the group)."""
    prints = written(with_fingerprint(df.select(F.col(key).alias("id"), F.col(text).alias("text")), "text", shingle)
                     .select("id", "fp"), "prints")
    points = written(prints.groupBy("fp").agg(F.min("id").alias("low")), "points")
    stars = components(links(points, distance)).select(F.col("a").alias("fp"), F.col("b").alias("star"))
    member = points.join(stars, "fp", "left").select("fp", "low", F.coalesce("star", "fp").alias("group"))
    lowest = member.groupBy("group").agg(F.min("low").alias("component_id"))
    member = member.select("fp", "group").join(lowest, "group")
    return prints.join(member, "fp").select(F.col("id").alias(key), "fp", "group", "component_id")
