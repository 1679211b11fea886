"""Exact nearest neighbours: range cells around pivots, two passes, no cross join.

1. Training rows of one vector are cut to their ``k`` smallest ids (no query can use more of them),
   before the shuffle by a group limit, so repeated points of any number are few.
2. A sample of points are pivots.  Each point belongs to the cell of its nearest pivot, and each
   cell is cut into rings by the distance to the pivot, of about BLOCK points; a ring that equal
   distances make larger is dealt to parts by a hash of the id.
3. First pass: a scored row meets the ring of its nearest pivot's cell in which it lies.  The k-th
   distance found there (or k points of the best cell, by the triangle inequality) bounds its
   true k-th distance.
4. Second pass: it meets the other rings that can still hold a point within that bound: with d
   the distance to the pivot, a ring of distances [lo, hi] only holds points at least
   max(lo - d, d - hi) away.
5. The nearest k of all it met, by distance and then by id, are its neighbours.

Rows meet by an equi-join on (ring, part, salt): a ring that many rows visit is copied to as many
salts as its visitors need, so a task holds about BLOCK points and BLOCK scored rows at once.
Distances are sums of squares from the first feature to the last, so equal ones are equal in any
layout.  The driver holds PIVOTS vectors and one line for each ring: training points / BLOCK.

Defined results: a row without training points has no neighbours; with fewer than k of them it
has all; repeated scored rows are answered one by one; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.session import ship_package, written_table

#: Pivots; training points of a ring and scored rows of a salt.
PIVOTS, BLOCK = 128, 2048
#: Bounds are widened by this factor against rounding.
_SLACK = 1 + 1e-9


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(float, copy=False).reshape(len(column), width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``, summed from the first feature on."""
    out = np.zeros((len(a), len(b)))
    for x, y in zip(a.T, b.T, strict=True):
        step = x[:, None] - y
        step *= step
        out += step
    return out


@dataclass
class Rings:
    """The rings of all cells, by cell and distance: bounds and sizes, on the driver and in each worker."""

    pivots: np.ndarray
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    parts: np.ndarray
    near: np.ndarray        # of each cell: the distance to the pivot within which it has k points (inf: fewer)

    def __post_init__(self):
        at = np.arange(len(self.pivots) + 1)
        self.edge = np.searchsorted(self.cell, at)

    def distances(self, rows: np.ndarray) -> np.ndarray:
        return np.sqrt(squared(rows, self.pivots))

    def home(self, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ring of each row, a bound of its k-th distance)."""
        filled = np.flatnonzero(np.diff(self.edge) > 0)
        cell = filled[d[:, filled].argmin(1)]
        ring = np.empty(len(d), np.int64)
        for c in np.unique(cell):
            some = cell == c
            a, b = self.edge[c], self.edge[c + 1]
            ring[some] = np.minimum(a + np.searchsorted(self.high[a:b], d[some, c]), b - 1)
        return ring, (d + self.near).min(1)

    def reached(self, d: np.ndarray, bound: np.ndarray, but: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, ring) of the rings that may hold a point within ``bound``, without ring ``but`` of the row."""
        rows, rings = [], []
        for c in np.flatnonzero(np.diff(self.edge) > 0):
            a, b = self.edge[c], self.edge[c + 1]
            first = a + np.searchsorted(self.high[a:b] * _SLACK, d[:, c] - bound * _SLACK)
            last = a + np.searchsorted(self.low[a:b], (d[:, c] + bound) * _SLACK, side="right")
            n = np.maximum(last - first, 0)
            row = np.repeat(np.arange(len(d)), n)
            rows.append(row)
            rings.append(first[row] + np.arange(len(row)) - (np.cumsum(n) - n)[row])
        row, ring = np.concatenate(rows), np.concatenate(rings)
        keep = ring != but[row]
        return row[keep], ring[keep]


def _spread(row: np.ndarray, ring: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, ring, part) for every part of each ring."""
    n = parts[ring]
    at = np.repeat(np.arange(len(ring)), n)
    return row[at], ring[at], np.arange(len(at)) - (np.cumsum(n) - n)[at]


def _take(batch: pa.RecordBatch, at: np.ndarray, **more) -> pa.RecordBatch:
    some = batch.take(pa.array(at))
    return pa.RecordBatch.from_arrays([*some.columns, *[pa.array(v) for v in more.values()]],
                                      names=[*some.schema.names, *more])


class NeighbourIndex:
    """The training rows in cells and rings (a written table), for searches of up to ``k`` neighbours."""

    def __init__(self, train: DataFrame, k: int, key: str, vector: str, value: str):
        spark = train.sparkSession
        ship_package(spark)
        self.spark, self.k = spark, k
        base = train.select(F.col(key).alias("id"), F.col(vector).alias("vec"), F.col(value).cast("double").alias("y"))
        same = Window.partitionBy("vec").orderBy("id", "y")
        points = written_table(base.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= k).drop("n"), "points")
        some = points.orderBy(F.xxhash64("vec"), "id").select("vec").limit(PIVOTS).collect()
        pivots = np.unique(np.array([r[0] for r in some], float), axis=0) if some else np.zeros((0, 0))
        self.rings = None
        if not len(pivots):
            return
        width = pivots.shape[1]

        def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                d = squared(_matrix(batch.column("vec"), width), pivots)
                yield _take(batch, np.arange(batch.num_rows), cell=d.argmin(1).astype(np.int32), d=np.sqrt(d.min(1)))

        dealt = points.mapInArrow(assign, T.StructType([*points.schema.fields, T.StructField("cell", T.IntegerType()),
                                                        T.StructField("d", T.DoubleType())]))
        dealt = written_table(dealt, "cells")
        sizes = dict(dealt.groupBy("cell").count().collect())                   # at most PIVOTS rows
        n_rings = -(-max(sizes.values()) // BLOCK)
        cuts = {}
        if n_rings > 1:
            probs = [i / n_rings for i in range(1, n_rings)]
            cuts = {c: np.unique(v) for c, v in dealt.groupBy("cell").agg(
                F.percentile_approx("d", probs, 20 * n_rings)).collect()}      # PIVOTS x rings numbers

        def ringed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cell, d = (batch.column(c).to_numpy() for c in ("cell", "d"))
                ring = np.zeros(len(d), np.int32)
                for c in np.unique(cell):
                    ring[cell == c] = np.searchsorted(cuts.get(c, ()), d[cell == c])
                yield _take(batch, np.arange(len(d)), ring=ring)

        table = dealt.mapInArrow(ringed, T.StructType([*dealt.schema.fields, T.StructField("ring", T.IntegerType())]))
        table = written_table(table, "rings")
        lines = sorted(table.groupBy("cell", "ring").agg(F.min("d"), F.max("d"), F.count("*")).collect())
        cell, _, low, high, n = (np.array(x) for x in zip(*lines, strict=True))
        near = np.full(len(pivots), np.inf)
        for c in range(len(pivots)):
            here = cell == c
            enough = np.flatnonzero(np.cumsum(n[here]) >= k)
            if len(enough):
                near[c] = high[here][enough[0]]
        self.rings = Rings(pivots, cell, low, high, -(-n // BLOCK), near)
        codes = np.array([c * n_rings + r for c, r, *_ in lines])

        def numbered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                cells, r = (batch.column(c).to_numpy() for c in ("cell", "ring"))
                at = np.searchsorted(codes, cells.astype(np.int64) * n_rings + r).astype(np.int32)
                some = batch.select(["id", "vec", "y", "hash"])
                yield _take(some, np.arange(len(at)), node=at)

        fields = [f for f in table.schema.fields if f.name in ("id", "vec", "y")]
        self.points = table.withColumn("hash", F.xxhash64("id", "vec")).mapInArrow(numbered, T.StructType(
            [*fields, T.StructField("hash", T.LongType()), T.StructField("node", T.IntegerType())]))

    def _meet(self, visits: DataFrame) -> DataFrame:
        """(row, d2, id, y): the k nearest points of each visit (row, vec, node, part), a written table."""
        visits = written_table(visits, "visits")
        counts = visits.groupBy("node", "part").count().collect()               # at most one row for each part of a ring
        salts = {(r[0], r[1]): -(-r[2] // BLOCK) for r in counts}
        parts, k = self.rings.parts, self.k
        width = self.rings.pivots.shape[1]
        most = np.zeros((len(parts), int(parts.max())), np.int64)
        for (node, part), s in salts.items():
            most[node, part] = s

        def copies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                node, hashed = (batch.column(c).to_numpy() for c in ("node", "hash"))
                part = (hashed.view(np.uint64) % parts[node].astype(np.uint64)).astype(np.int64)
                n = most[node, part]
                at = np.repeat(np.arange(len(node)), n)
                salt = np.arange(len(at)) - (np.cumsum(n) - n)[at]
                some = batch.select(["id", "vec", "y"])
                yield _take(some, at, node=node[at].astype(np.int32), part=part[at].astype(np.int32), salt=salt.astype(np.int32))

        def salted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                node, part, row = (batch.column(c).to_numpy() for c in ("node", "part", "row"))
                mixed = (row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                salt = (mixed % np.maximum(most[node, part], 1).astype(np.uint64)).astype(np.int32)
                yield _take(batch, np.arange(len(row)), salt=salt)

        def search(left: pa.Table, right: pa.Table) -> pa.Table:
            kind = right.schema.field("id").type if right.num_columns else pa.int64()
            schema = pa.schema([("row", pa.int64()), ("d2", pa.float64()), ("id", kind), ("y", pa.float64())])
            if not left.num_rows or not right.num_rows:
                return schema.empty_table()
            right = right.sort_by("id")
            there = _matrix(right.column("vec").combine_chunks(), width)
            here = _matrix(left.column("vec").combine_chunks(), width)
            row = left.column("row").to_numpy()
            found = []
            for a in range(0, len(here), 256):
                d2 = squared(here[a:a + 256], there)
                if d2.shape[1] > k:
                    at, col = np.nonzero(d2 <= np.partition(d2, k - 1, axis=1)[:, k - 1:k])
                else:
                    at, col = np.nonzero(d2 >= 0)
                order = np.lexsort((col, d2[at, col], at))
                at, col = at[order], col[order]
                rank = np.arange(len(at)) - np.searchsorted(at, at)
                found.append((at[rank < k] + a, col[rank < k], d2[at[rank < k], col[rank < k]]))
            at, col, d2 = (np.concatenate(x) for x in zip(*found, strict=True))
            near = right.select(["id", "y"]).take(pa.array(col))
            return pa.table([pa.array(row[at]), pa.array(d2), near.column("id").combine_chunks(), near.column("y").combine_chunks()],
                            schema=schema)

        keys = [T.StructField(c, T.IntegerType()) for c in ("node", "part", "salt")]
        fields = [f for f in self.points.schema.fields if f.name in ("id", "vec", "y")]
        right = self.points.mapInArrow(copies, T.StructType([*fields, *keys]))
        left = visits.mapInArrow(salted, T.StructType([*visits.schema.fields, keys[2]]))
        names = ["node", "part", "salt"]
        out = T.StructType([T.StructField("row", T.LongType()), T.StructField("d2", T.DoubleType()), fields[0], fields[2]])
        return written_table(left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(search, out), "met")

    def _best(self, met: DataFrame) -> DataFrame:
        order = Window.partitionBy("row").orderBy("d2", "id", "y")
        return met.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= self.k)

    def search(self, scored: DataFrame, row: str, vector: str) -> DataFrame:
        """(row, place, d2, id, y): the neighbours of each scored row, 1, 2, ... up to k; ``row`` is a unique long."""
        rows = scored.select(F.col(row).cast("long").alias("row"), F.col(vector).alias("vec"))
        if self.rings is None:
            return self.spark.createDataFrame([], "row long, place int, d2 double, id long, y double")
        rings, k = self.rings, self.k
        width = rings.pivots.shape[1]
        keys = [T.StructField("node", T.IntegerType()), T.StructField("part", T.IntegerType())]
        schema = T.StructType([*rows.schema.fields, *keys])

        def spread(batch, at, ring):
            at, node, part = _spread(at, ring, rings.parts)
            return _take(batch.select(["row", "vec"]), at, node=node.astype(np.int32), part=part.astype(np.int32))

        def first(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ring, _ = rings.home(rings.distances(_matrix(batch.column("vec"), width)))
                yield spread(batch, np.arange(len(ring)), ring)

        def second(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 512):
                    part = batch.slice(a, 512)
                    d = rings.distances(_matrix(part.column("vec"), width))
                    ring, bound = rings.home(d)
                    known = np.sqrt(part.column("bound").to_numpy(zero_copy_only=False).astype(float))
                    bound = np.fmin(bound, known)
                    yield spread(part, *rings.reached(d, bound, ring))

        near = self._best(self._meet(rows.mapInArrow(first, schema)))
        bounds = near.groupBy("row").agg(F.when(F.count("*") >= k, F.max("d2")).alias("bound"))
        more = self._meet(rows.join(bounds, "row", "left").mapInArrow(second, schema))
        return self._best(near.drop("place").unionByName(more)).select("row", "place", "d2", "id", "y")


def nearest(scored: DataFrame, train: DataFrame, k: int, row: str, key: str, vector: str, value: str) -> DataFrame:
    """Neighbours of ``scored`` (unique long ``row``, array ``vector``) among ``train`` (``key``, ``vector``, ``value``)."""
    return NeighbourIndex(train, k, key, vector, value).search(scored, row, vector)

