"""Regression trees on coded columns: rows as blocks of small integers, scanned by numpy in the workers.

A vector slot becomes a column of codes: the rank of its value among the slot's cuts, which come from
all rows (every midpoint of distinct values, or quantiles where there are more than ``max_codes``).
0/1 slots that no row has together (one-hot groups) share one column, whose code names the slot that
is 1; a split on such a code is the slot's own 0/1 split.  A block holds up to ``BLOCK_CELLS`` cells,
so that a pass over a column is one ``bincount`` a block, and rows take a byte or two a column.

Which rows a tree takes follows from a hash of the row's id, so it doesn't depend on the partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel
from pyspark.serializers import BatchedSerializer, CPickleSerializer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators.state import StageHolder
from plinth.session import checkpoint_dir, ship_package

BLOCK_CELLS = 4_000_000
#: Values of all slots' tables of cuts together, which the driver holds.
TABLE_VALUES = 4_000_000
#: Partitions from which their histograms are added up on the executors first.
DIRECT_PARTITIONS = 64
CHECKPOINT_TREES = 10


@dataclass(frozen=True)
class Columns:
    """``cuts[c]`` of a numeric column, None of a one-hot group; ``slots[c]``: its vector slot, or those of codes 1, 2, ..."""
    cuts: list
    slots: list
    coarse: list                     # of each code its bin; at most 256 bins of a column, with like numbers of rows

    @property
    def widths(self) -> list[int]:
        return [len(s) + 1 if c is None else len(c) + 1 for c, s in zip(self.cuts, self.slots)]

    @property
    def grouped(self) -> np.ndarray:
        return np.array([c is None for c in self.cuts], bool)

    def codes(self, x: np.ndarray) -> np.ndarray:
        """[column, row] codes of rows of vectors."""
        out = np.zeros((len(self.cuts), len(x)), np.uint8 if max(self.widths) <= 256 else np.uint16)
        for c, (cuts, slots) in enumerate(zip(self.cuts, self.slots)):
            if cuts is not None:
                out[c] = np.searchsorted(cuts, x[:, slots[0]], side="left")
            else:
                for k, j in enumerate(slots):
                    out[c][x[:, j] == 1] = k + 1
        return out

    def split(self, column: int, cut: int) -> tuple[int, float]:
        """(slot, threshold): the vector's values up to the threshold go left."""
        if self.cuts[column] is None:
            return self.slots[column][cut - 1], 0.5
        return self.slots[column][0], float(self.cuts[column][cut])


def _chunks(batches):
    """(x, y, h) of rows as they come, up to about BLOCK_CELLS cells each."""
    held, n = [], 0
    for b in batches:
        if b.num_rows:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            held.append((x, b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)))
            n += x.size
        if n >= BLOCK_CELLS:
            yield tuple(np.concatenate(p) for p in zip(*held))
            held, n = [], 0
    if held:
        yield tuple(np.concatenate(p) for p in zip(*held))


def _merged(tables, limit: int):
    """Sorted distinct values with their counts; more than ``limit`` values become that many at even ranks,
    each with the rows up to it."""
    values = np.concatenate([t[0] for t in tables])
    order = np.argsort(values, kind="stable")
    values, counts = values[order], np.concatenate([t[1] for t in tables])[order]
    at = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    values, counts = values[at], np.add.reduceat(counts, at)
    if len(values) > limit:
        up = np.cumsum(counts)
        keep = np.unique(np.searchsorted(up, np.linspace(up[-1] / limit, up[-1], limit)).clip(max=len(values) - 1))
        values, counts = values[keep], np.diff(up[keep], prepend=0)
    return values, counts


def _tables(limit: int):
    """A partition's table of values of each slot, and which 0/1 slots met in one row (slot -1)."""
    def run(batches):
        tables, met = {}, None
        for x, _, _ in _chunks(batches):
            binary = ((x == 0) | (x == 1)).all(axis=0)
            ones = np.where(binary, x, 0).astype(np.float32)
            both = (ones.T @ ones) > 0
            met = both if met is None else met | both
            for j in range(x.shape[1]):
                if binary[j]:
                    n = int(ones[:, j].sum(dtype=np.float64))
                    new = np.array([v for v, k in ((0.0, len(x) - n), (1.0, n)) if k]), np.array([k for k in (len(x) - n, n) if k])
                else:
                    new = np.unique(x[:, j] + 0.0, return_counts=True)
                tables[j] = _merged([tables[j], new] if j in tables else [new], limit)
        rows = [(j, v.astype(np.float64).tobytes(), n.astype(np.int64).tobytes()) for j, (v, n) in tables.items()]
        if met is not None:
            rows.append((-1, np.packbits(met).tobytes(), b""))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.binary())], ["slot", "v", "n"])
    return run


def _table(row):
    v = np.frombuffer(row[1], np.uint8 if row[0] < 0 else np.float64)
    return row[0], (v, np.frombuffer(row[2], np.int64))


def _cuts(values: np.ndarray, counts: np.ndarray, max_codes: int) -> np.ndarray:
    """Midpoints between neighbours; of more than ``max_codes`` values those nearest to even ranks."""
    with np.errstate(invalid="ignore"):
        mid = values[:-1] + (values[1:] - values[:-1]) / 2
    mid = np.where(mid < values[1:], mid, values[:-1])          # next to each other, or infinite
    if len(mid) < max_codes:
        return mid
    up = np.cumsum(counts)
    return mid[np.unique(np.searchsorted(up[:-1], np.arange(1, max_codes) * up[-1] / max_codes).clip(max=len(mid) - 1))]


def raw_rows(df: DataFrame, features_col: str, label_col: str, id_col: str | None) -> DataFrame:
    x, y = vector_to_array(F.col(features_col)), F.col(label_col).cast("double")
    key = F.xxhash64(F.col(id_col)) if id_col is not None and id_col in df.columns else F.xxhash64(x, y)
    return df.select(x.alias("x"), y.alias("y"), key.alias("h"))


def fit_columns(rows: DataFrame, max_codes: int) -> tuple[Columns, int, int]:
    """The columns of all rows, in one pass, the number of rows and that of slots."""
    first = rows.select(F.size("x")).first()
    if first is None:
        raise ValueError("no rows to fit trees on")
    p = first[0]
    limit = max(256, min(65_536, TABLE_VALUES // p))

    def both(a, b):
        return (a[0] | b[0], a[1]) if a[0].dtype == np.uint8 else _merged([a, b], limit)

    found = dict(rows.mapInArrow(_tables(limit), "slot int, v binary, n binary").rdd.map(_table)
                 .reduceByKey(both, min(p, rows.sparkSession.sparkContext.defaultParallelism)).collect())
    met = np.unpackbits(found.pop(-1)[0], count=p * p).reshape(p, p).astype(bool)
    cuts, slots, groups, coarse = [], [], [], []
    for j in range(p):
        values, counts = found[j]
        if len(values) == 2 and tuple(values) == (0.0, 1.0):
            group = next((g for g in groups if len(g) < 255 and not met[j, g].any()), None)
            if group is None:
                groups.append([j])
            else:
                group.append(j)
        elif len(values) > 1:
            cuts.append(_cuts(values, counts, max_codes))
            slots.append([j])
            up = np.cumsum(np.bincount(np.searchsorted(cuts[-1], values), counts, len(cuts[-1]) + 1))
            bins = np.arange(len(up)) if len(up) <= 256 else np.unique((np.r_[0, up[:-1]] * 256 // up[-1]), return_inverse=True)[1]
            coarse.append(bins.astype(np.uint8))
    if not cuts and not groups:                                # every slot is constant: one column of one code
        cuts, slots, coarse = [np.empty(0)], [[0]], [np.zeros(1, np.uint8)]
    coarse += [np.arange(len(g) + 1, dtype=np.uint8) for g in groups]
    return Columns(cuts + [None] * len(groups), slots + groups, coarse), int(found[0][1].sum()), p


def blocks(rows: DataFrame, columns: Columns) -> RDD:
    """(codes, y, h) of each block; one block to a pickle, so that the state of rows can be zipped to it."""
    sent = rows.sparkSession.sparkContext.broadcast(columns)

    def coded(batches):
        for x, y, h in _chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (sent.value.codes(x), y, h)], ["c", "y", "h"])

    small = max(columns.widths) <= 256

    def block(r):
        y = np.frombuffer(r[1], np.float64)
        return np.frombuffer(r[0], np.uint8 if small else np.uint16).reshape(-1, len(y)), y, np.frombuffer(r[2], np.uint64)

    return _one_by_one(rows.mapInArrow(coded, "c binary, y binary, h binary").rdd.map(block))


def _one_by_one(rdd: RDD) -> RDD:
    return rdd._reserialize(BatchedSerializer(CPickleSerializer(), 1))


def drawn(h: np.ndarray, seed: int, tree: int) -> np.ndarray:
    """A number in [0, 1) for each row and tree."""
    at = ((seed & 0xFFFFFFFF) << 32 | tree) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    z = h ^ np.uint64(at)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) * 2.0 ** -53


class Tree:
    """Nodes as lists: ``column`` -1 is a leaf; the children of i are ``left[i]`` and ``left[i] + 1``."""

    def __init__(self):
        self.column, self.cut, self.left, self.value, self.gain, self.n = [-1], [0], [0], [0.0], [0.0], [0.0]
        self.ended: set = set()          # leaves that can't be split

    def grow(self, i: int, column: int, cut: int, gain: float, values: list, ns: list) -> list[int]:
        self.column[i], self.cut[i], self.left[i], self.gain[i] = column, cut, len(self.column), gain
        for v, n in zip(values, ns):
            for to, x in ((self.column, -1), (self.cut, 0), (self.left, 0), (self.value, v), (self.gain, 0.0), (self.n, n)):
                to.append(x)
        return [self.left[i], self.left[i] + 1]

    def arrays(self):
        return (np.array(self.column, np.int32), np.array(self.cut, np.int32), np.array(self.left, np.int32), np.array(self.value))


def nodes_of(tree, grouped: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The node each row ends in."""
    column, cut, left, _ = tree
    at = np.zeros(codes.shape[1], np.int32)
    live = np.arange(codes.shape[1])
    while len(live):
        node = at[live]
        inner = column[node] >= 0
        if not inner.all():
            live, node = live[inner], node[inner]
        col = column[node]
        code, cuts = codes[col, live], cut[node]
        at[live] = left[node] + np.where(grouped[col], code == cuts, code > cuts)
    return at


def histogram(node: np.ndarray, codes: np.ndarray, widths: list[int], n_nodes: int, r: np.ndarray, w: np.ndarray | None = None) -> np.ndarray:
    """[2, node, code of each column in turn]: rows (or sums of ``w``) and sums of ``r``; rows of the node ``n_nodes``
    count nowhere."""
    out, offset = np.empty((2, n_nodes, sum(widths))), 0
    key = np.empty(len(node), np.int64)
    for c, width in enumerate(widths):
        np.multiply(node, width, out=key)
        key += codes[c]
        size = (n_nodes + 1) * width
        out[0, :, offset:offset + width] = np.bincount(key, w, size).reshape(-1, width)[:n_nodes]
        out[1, :, offset:offset + width] = np.bincount(key, r, size).reshape(-1, width)[:n_nodes]
        offset += width
    return out


def _added(rdd: RDD) -> np.ndarray:
    return rdd.treeReduce(np.add) if rdd.getNumPartitions() > DIRECT_PARTITIONS else rdd.reduce(np.add)


def best_splits(hist: np.ndarray, columns: Columns, allowed, least: int = 1) -> list:
    """(gain, column, cut, left n, left sum, right n, right sum) of each node, or None; ``allowed(node)``:
    a mask of slots or None for all."""
    out = []
    for i in range(hist.shape[1]):
        mask, best, offset = allowed(i), None, 0
        for c, w in enumerate(columns.widths):
            n, s = hist[0, i, offset:offset + w], hist[1, i, offset:offset + w]
            offset += w
            total_n, total_s = n.sum(), s.sum()
            if columns.cuts[c] is None:
                nr, sr = n[1:], s[1:]
                nl, sl, first = total_n - nr, total_s - sr, 1
                open_ = np.ones(w - 1, bool) if mask is None else mask[columns.slots[c]]
            else:
                nl, sl = np.cumsum(n)[:-1], np.cumsum(s)[:-1]
                nr, sr, first = total_n - nl, total_s - sl, 0
                open_ = mask is None or mask[columns.slots[c][0]]
            good = (nl >= least) & (nr >= least) & open_
            if not good.any():
                continue
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(good, sl * sl / nl + sr * sr / nr, -np.inf)
            k, base = int(np.argmax(gain)), total_s * total_s / total_n
            g = float(gain[k] - base)
            if g > 1e-12 * abs(base) and (best is None or g > best[0]):
                best = (g, c, k + first, float(nl[k]), float(sl[k]), float(nr[k]), float(sr[k]))
        out.append(best)
    return out


class BoostedTreesRegressor(StageHolder, Estimator):
    """Gradient boosting by squared error as MLlib's ``GBTRegressor`` does it: the first tree fits the label, each
    further one twice the residual and counts ``step``.  The fitted model is MLlib's.

    A level of a tree is one pass over the blocks; between trees each row keeps its prediction so far."""

    def __init__(self, trees: int = 100, step: float = 0.1, depth: int = 6, subsample: float = 1.0, features: float = 1.0,
                 seed: int = 42, max_codes: int = 256, features_col: str = "features", label_col: str = "label",
                 id_col: str | None = None):
        super().__init__()
        self.trees, self.step, self.depth, self.subsample, self.features = trees, step, depth, subsample, features
        self.seed, self.max_codes, self.features_col, self.label_col, self.id_col = seed, max_codes, features_col, label_col, id_col

    def settings(self) -> dict:
        names = ("trees", "step", "depth", "subsample", "features", "seed", "max_codes", "features_col", "label_col", "id_col")
        return {n: getattr(self, n) for n in names}

    def getMaxDepth(self) -> int:
        return self.depth

    def getSeed(self) -> int:
        return self.seed

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        spark = dataset.sparkSession
        ship_package(spark)
        checkpoint_dir(spark)
        rows = raw_rows(dataset, self.features_col, self.label_col, self.id_col)
        columns, _, size = fit_columns(rows, self.max_codes)
        held = blocks(rows, columns).persist(StorageLevel.MEMORY_AND_DISK)
        state = _one_by_one(held.map(lambda b: np.zeros(len(b[1]))))
        trees, kept = [], None
        try:
            for t in range(self.trees):
                pairs = held.zip(state)
                tree = self._tree(pairs, columns, t, size)
                if kept is not None:
                    kept.unpersist()
                trees.append(tree)
                if t + 1 < self.trees:
                    kept, state = state if t else None, self._after(pairs, columns, tree, t)
        finally:
            for x in (held, state, kept):
                if x is not None:
                    x.unpersist()
        weights = [1.0] + [self.step] * (len(trees) - 1)
        return _boosted_model(spark, trees, weights, columns, size).setFeaturesCol(self.features_col).setPredictionCol("prediction")

    def _after(self, pairs: RDD, columns: Columns, tree: Tree, t: int) -> RDD:
        """The rows' predictions with one more tree."""
        arrays, grouped, weight = tree.arrays(), columns.grouped, self.step if t else 1.0
        state = _one_by_one(pairs.map(lambda p: p[1] + weight * arrays[3][nodes_of(arrays, grouped, p[0][0])]))
        state.persist(StorageLevel.MEMORY_AND_DISK)
        if (t + 1) % CHECKPOINT_TREES == 0:
            state.checkpoint()
        return state

    def _tree(self, pairs: RDD, columns: Columns, t: int, size: int) -> Tree:
        widths, grouped, seed, share = columns.widths, columns.grouped, self.seed, self.subsample
        chosen = max(1, int(np.ceil(self.features * size - 1e-9)))
        tree, live = Tree(), [0]
        for _ in range(max(1, self.depth)):
            arrays, slot = tree.arrays(), np.full(len(tree.column), len(live), np.int64)
            slot[live] = np.arange(len(live))

            def scan(part, arrays=arrays, slot=slot, n=len(live)):
                total = np.zeros((2, n, sum(widths)))
                for (codes, y, h), f in part:
                    node = slot[nodes_of(arrays, grouped, codes)]
                    if share < 1:
                        node[drawn(h, seed, t) >= share] = n
                    total += histogram(node, codes, widths, n, 2 * (y - f) if t else y)
                yield total

            hist = _added(pairs.mapPartitions(scan))
            if live == [0]:
                n, s = hist[:, 0, :widths[0]].sum(axis=1)
                tree.n[0], tree.value[0] = float(n), float(s / n) if n else 0.0
            if not self.depth:
                break

            def allowed(i, live=tuple(live)):
                if chosen >= size:
                    return None
                mask = np.zeros(size, bool)
                mask[np.random.default_rng((self.seed & 0xFFFFFFFF, t, live[i])).choice(size, chosen, replace=False)] = True
                return mask

            found, live_next = best_splits(hist, columns, allowed), []
            for i, best in zip(live, found):
                if best is not None:
                    gain, column, cut, nl, sl, nr, sr = best
                    live_next += tree.grow(i, column, cut, gain, [sl / nl, sr / nr], [nl, nr])
            live = live_next
            if not live:
                break
        return tree


def _boosted_model(spark, trees: list[Tree], weights: list[float], columns: Columns, size: int) -> GBTRegressionModel:
    """MLlib's model of these trees.  Impurities are not kept, the gains are."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    uid = lambda kind: jvm.org.apache.spark.ml.util.Identifiable.randomUID(kind)

    def doubles(xs):
        out = gateway.new_array(gateway.jvm.double, len(xs))
        for i, x in enumerate(xs):
            out[i] = float(x)
        return out

    def node(tree, i):
        n, value = tree.n[i], tree.value[i]
        stats = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(doubles([n, n * value, n * value * value]), int(n))
        if tree.column[i] < 0:
            return ml.tree.LeafNode(value, 0.0, stats)
        slot, threshold = columns.split(tree.column[i], tree.cut[i])
        return ml.tree.InternalNode(value, 0.0, tree.gain[i] / n, node(tree, tree.left[i]), node(tree, tree.left[i] + 1),
                                    ml.tree.ContinuousSplit(slot, threshold), stats)

    made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    for i, t in enumerate(trees):
        made[i] = ml.regression.DecisionTreeRegressionModel(uid("dtr"), node(t, 0), size)
    return GBTRegressionModel(ml.regression.GBTRegressionModel(uid("gbtr"), made, doubles(weights), size))
