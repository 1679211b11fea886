"""Random forests on coded columns (``trees``): every tree on its own draw of all rows, as deep as it grows.

While a node holds more rows than one task takes (``LOCAL_CELLS``), its split comes from histograms of all blocks; what is
left, a part, is grown in one task, all nodes of a level together, with every code as a cut.  A table that is small
enough goes to the tasks as it is, and each tree is one part.

The fitted trees are a table with a row for each part, which never goes to the driver.  Rows to predict are sent to
the parts they fall into, and the parts' sums are added up for each row.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators.state import StageHolder
from plinth.operators.trees import Columns, Tree, _added, best_splits, blocks, drawn, fit_columns, histogram, nodes_of, raw_rows
from plinth.session import checkpoint_dir, ship_package, written_table

#: Codes of the rows that one task holds to grow a part.
LOCAL_CELLS = 8_000_000
#: Cells of a pass's histograms, and bytes of rows that are dealt out to parts at once.
PASS_CELLS, DEALT_BYTES = 500_000, 8_000_000_000
#: Bytes of trees and codes of rows that a task predicts with at once.
GROUP_BYTES, GROUP_CELLS = 64_000_000, 50_000_000
MAX_CODES = 65_536

_PARTS = "tree int, part int, column binary, cut binary, left binary, value binary"
_POISSON = np.cumsum(np.exp(-1) / np.cumprod(np.r_[1, np.arange(1, 16)]))


def draws(h: np.ndarray, seed: int, tree: int, bootstrap: bool) -> np.ndarray:
    """How often a tree takes each row: Poisson numbers of mean 1, or once."""
    return np.searchsorted(_POISSON, drawn(h, seed, tree), side="right").astype(np.float64) if bootstrap else np.ones(len(h))


def grow(codes: np.ndarray, y: np.ndarray, w: np.ndarray, columns: Columns, least: int = 1, depth: int | None = None):
    """(column, cut, left, value) of the tree of these rows, by squared error; leaves are pure, too small to be split,
    or of rows with equal codes."""
    widths, grouped, m = columns.widths, columns.grouped, len(y)
    column, cut = np.full(2 * m + 1, -1, np.int16), np.zeros(2 * m + 1, np.uint16)
    left, value = np.zeros(2 * m + 1, np.int32), np.zeros(2 * m + 1)
    middle = np.average(y, weights=w) if m else 0.0
    given, y = y, y - middle
    rows, start, ids, total, level = np.arange(m), np.array([0]), np.array([0]), 1, 0
    bits = max(1, int(m).bit_length())
    while m and len(ids):
        n, s = np.add.reduceat(w[rows], start), np.add.reduceat(w[rows] * y[rows], start)
        value[ids] = s / n + middle
        if depth is not None and level >= depth:
            break
        low = np.minimum.reduceat(given[rows], start)
        pure = low == np.maximum.reduceat(given[rows], start)
        value[ids[pure]] = low[pure]
        open_ = ~pure & (n >= 2 * least)
        rows, start, ids, n, s = _kept(rows, start, open_, ids, n, s)
        if not len(ids):
            break
        k, node = len(ids), np.repeat(np.arange(len(ids)), np.diff(np.r_[start, len(rows)]))
        ww, wy = w[rows], w[rows] * y[rows]
        best, at_column, at_cut = np.full(k, -np.inf), np.full(k, -1), np.zeros(k, np.int64)
        for c, width in enumerate(widths):
            key = node * width + codes[c, rows]
            find = _dense if k * width <= 4 * len(rows) else _sparse
            gain, where = find(key, k, width, bool(grouped[c]), ww, wy, n, s, least, bits)
            better = gain > best + _near(best)
            best[better], at_column[better], at_cut[better] = gain[better], c, where[better]
        split = at_column >= 0
        inner = ids[split]
        column[inner], cut[inner], left[inner] = at_column[split], at_cut[split], total + 2 * np.arange(len(inner))
        rows, start, at_column, at_cut = _kept(rows, start, split, at_column, at_cut)
        if not len(start):
            break
        node = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(rows)]))
        code = codes[at_column[node], rows]
        right = np.where(grouped[at_column[node]], code == at_cut[node], code > at_cut[node])
        key = np.sort((node * 2 + right) << bits | np.arange(len(rows)))
        rows, side = rows[key & ((1 << bits) - 1)], key >> bits
        start = np.flatnonzero(np.r_[True, side[1:] != side[:-1]])
        ids = total + np.arange(2 * len(inner))
        total, level = total + 2 * len(inner), level + 1
    return column[:total], cut[:total], left[:total], value[:total]


def _kept(rows, start, keep, *per_node):
    """Rows, starts and further arrays of the nodes to keep."""
    if keep.all():
        return rows, start, *per_node
    sizes = np.diff(np.r_[start, len(rows)])
    rows, sizes = rows[np.repeat(keep, sizes)], sizes[keep]
    return rows, np.r_[0, np.cumsum(sizes)[:-1]].astype(np.int64)[:len(sizes)], *(x[keep] for x in per_node)


def _gains(nl, sl, nr, sr, good, least):
    good = good & (nl >= least) & (nr >= least) & (nl > 0) & (nr > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(good, sl * sl / nl + sr * sr / nr, -np.inf)


def _near(gain: np.ndarray) -> np.ndarray:
    """What two gains may differ by rounding: of equal ones the first column and the lowest cut win."""
    return 1e-10 * np.abs(np.where(np.isfinite(gain), gain, 0.0))


def _dense(key, k, width, group, ww, wy, n, s, least, bits):
    """(gain, cut) of each node's best split on one column, from a table of all codes."""
    n_, s_ = (np.bincount(key, x, k * width).reshape(k, width) for x in (ww, wy))
    if group:
        nr, sr = n_[:, 1:], s_[:, 1:]
        nl, sl = n[:, None] - nr, s[:, None] - sr
    else:
        nl, sl = np.cumsum(n_, 1)[:, :-1], np.cumsum(s_, 1)[:, :-1]
        nr, sr = n[:, None] - nl, s[:, None] - sl
    if not nl.shape[1]:
        return np.full(k, -np.inf), np.zeros(k, np.int64)
    gain = _gains(nl, sl, nr, sr, n_[:, 1:] > 0 if group else n_[:, :-1] > 0, least)
    top = gain.max(1)
    return top, np.argmax(gain >= (top - _near(top))[:, None], 1) + group


def _sparse(key, k, width, group, ww, wy, n, s, least, bits):
    """The same from the codes that occur, where a table would be mostly empty."""
    if (k * width).bit_length() + bits < 63:                  # far quicker than to sort positions by the key
        packed = np.sort(key << bits | np.arange(len(key)))
        key, pos = packed >> bits, packed & ((1 << bits) - 1)
    else:
        pos = np.argsort(key, kind="stable")
        key = key[pos]
    runs = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    node, code = key[runs] // width, key[runs] % width
    rn, rs = np.add.reduceat(ww[pos], runs), np.add.reduceat(wy[pos], runs)
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    if group:
        nr, sr, good = rn, rs, code > 0
        nl, sl = n[node] - nr, s[node] - sr
    else:
        cn, cs = np.cumsum(rn), np.cumsum(rs)
        nl, sl = cn - (cn[first] - rn[first])[node], cs - (cs[first] - rs[first])[node]
        nr, sr, good = n[node] - nl, s[node] - sl, np.r_[node[1:] == node[:-1], False]
    gain = _gains(nl, sl, nr, sr, good, least)
    top = np.maximum.reduceat(gain, first)
    hit = np.flatnonzero(gain >= (top - _near(top))[node])[::-1]
    at = np.zeros(k, np.int64)
    at[node[hit]] = code[hit]
    return top, at


def _batch(rows: list) -> pa.RecordBatch:
    names = [x.split()[0] for x in _PARTS.split(", ")]
    kinds = [pa.int32(), pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array([r[i] if i < 2 else r[i].tobytes() for r in rows], t) for i, t in enumerate(kinds)], names)


def _arrays(row) -> tuple:
    return tuple(np.frombuffer(row[x], t) for x, t in (("column", np.int16), ("cut", np.uint16), ("left", np.int32), ("value", np.float64)))


class ForestModel(StageHolder, Model):
    """The mean of the trees.  ``columns``, ``tops`` and ``parts`` are tables: the coded columns, the upper nodes of each
    tree, whose leaves name a part, and the parts."""

    def __init__(self, trees: int, rows: int, features_col: str, columns: DataFrame, tops: DataFrame, parts: DataFrame,
                 prediction_col: str = "prediction"):
        super().__init__()
        self.trees, self.rows, self.features_col, self.prediction_col = trees, rows, features_col, prediction_col
        self.columns, self.tops, self.nodes = columns, tops, parts

    def settings(self) -> dict:
        return {"trees": self.trees, "rows": self.rows, "features_col": self.features_col, "prediction_col": self.prediction_col}

    def parts(self) -> dict:
        return {"columns": self.columns, "tops": self.tops, "parts": self.nodes}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        ship_package(spark)
        rows = written_table(dataset.withColumn("__row", F.monotonically_increasing_id()), "scored")
        columns, tops = _columns_of(self.columns), _tops_of(self.tops)
        single = all(len(t[0]) == 1 for t in tops.values())
        together = max(1, min(GROUP_BYTES // (32 * max(1, self.rows)), -(-len(tops) // spark.sparkContext.defaultParallelism))) if single else 1
        salts = max(1, -(-rows.count() * len(columns.cuts) // GROUP_CELLS)) if single else 1
        stride = 1 + max(int(t[3].max()) for t in tops.values())
        sent = spark.sparkContext.broadcast((columns, tops))

        def routed(batches):
            columns, tops = sent.value
            for b in batches:
                if not b.num_rows:
                    continue
                ids = b.column(0).to_numpy()
                codes = columns.codes(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)).astype(np.uint16)
                if single:
                    salt = (int(ids[0]) * 0x9E3779B97F4A7C15 >> 40) % salts
                    yield _sent([(g * salts + salt, ids, codes) for g in range(-(-len(tops) // together))])
                    continue
                for t, (column, cut, left, part) in tops.items():
                    at = part[nodes_of((column, cut, left, None), columns.grouped, codes)]
                    yield _sent([(t * stride + int(p), ids[at == p], codes[:, at == p]) for p in np.unique(at)])

        def scored(trees: pa.Table, sent_rows: pa.Table) -> pa.Table:
            if not trees.num_rows or not sent_rows.num_rows:
                return pa.table({"__row": pa.array([], pa.int64()), "s": pa.array([], pa.float64())})
            grouped = sent.value[0].grouped
            ids, blocks_ = [], []
            for r in sent_rows.to_pylist():
                ids.append(np.frombuffer(r["ids"], np.int64))
                blocks_.append(np.frombuffer(r["codes"], np.uint16).reshape(-1, len(ids[-1])))
            codes, out = np.concatenate(blocks_, axis=1), 0.0
            for i in range(trees.num_rows):
                tree = _arrays(trees.slice(i, 1).to_pylist()[0])
                out = out + tree[3][nodes_of(tree, grouped, codes)]
            return pa.table({"__row": np.concatenate(ids), "s": out})

        asked = rows.select("__row", vector_to_array(F.col(self.features_col)).alias("x")) \
            .mapInArrow(routed, "g long, ids binary, codes binary")
        group = F.floor(F.col("tree") / together) * salts if single else F.col("tree").cast("long") * stride + F.col("part")
        trees = self.nodes.withColumn("g", group.cast("long"))
        if single and salts > 1:
            trees = trees.withColumn("g", F.explode(F.transform(F.sequence(F.lit(0), F.lit(salts - 1)), lambda i: F.col("g") + i)))
        sums = trees.groupBy("g").cogroup(asked.groupBy("g")).applyInArrow(scored, "__row long, s double")
        means = sums.groupBy("__row").agg((F.sum("s") / self.trees).alias(self.prediction_col))
        return rows.join(means, "__row", "left").drop("__row")


def _sent(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64())] + [
        pa.array([np.ascontiguousarray(r[i]).tobytes() for r in rows], pa.binary()) for i in (1, 2)], ["g", "ids", "codes"])


def _columns_of(table: DataFrame) -> Columns:
    found = sorted(table.collect(), key=lambda r: r["column"])
    return Columns([None if r["cuts"] is None else np.frombuffer(r["cuts"]) for r in found],
                   [np.frombuffer(r["slots"], np.int64).tolist() for r in found], [])


def _tops_of(table: DataFrame) -> dict:
    return {r["tree"]: tuple(np.frombuffer(r[x], np.int32) for x in ("column", "cut", "left", "part")) for r in table.collect()}


class ForestRegressor(StageHolder, Estimator):
    """A random forest by squared error over all slots; without ``depth`` trees grow until their leaves are pure."""

    def __init__(self, trees: int = 100, depth: int | None = None, least: int = 1, bootstrap: bool = True, seed: int = 42,
                 features_col: str = "features", label_col: str = "label", id_col: str | None = None):
        super().__init__()
        self.trees, self.depth, self.least, self.bootstrap, self.seed = trees, depth, least, bootstrap, seed
        self.features_col, self.label_col, self.id_col = features_col, label_col, id_col

    def settings(self) -> dict:
        return {n: getattr(self, n) for n in ("trees", "depth", "least", "bootstrap", "seed", "features_col", "label_col", "id_col")}

    def getMaxDepth(self) -> int | None:
        return self.depth

    def getSeed(self) -> int:
        return self.seed

    def _fit(self, dataset: DataFrame) -> ForestModel:
        spark = dataset.sparkSession
        ship_package(spark)
        checkpoint_dir(spark)
        rows = raw_rows(dataset, self.features_col, self.label_col, self.id_col)
        columns, n, _ = fit_columns(rows, MAX_CODES)
        most = max(1, LOCAL_CELLS // len(columns.cuts))
        held = blocks(rows, columns).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if n <= most:
                tops = [Tree() for _ in range(self.trees)]
                parts = written_table(self._whole(spark, held, columns), "forest")
            else:
                tops = self._tops(held, columns, most)
                parts = self._dealt(spark, held, columns, tops, n)
        finally:
            held.unpersist()
        table = [(t, *(a.astype(np.int32).tobytes() for a in (*x.arrays()[:3], _numbered(x)))) for t, x in enumerate(tops)]
        coded = [(c, np.array(s, np.int64).tobytes(), None if v is None else v.tobytes()) for c, (v, s) in enumerate(zip(columns.cuts, columns.slots))]
        return ForestModel(self.trees, min(n, most), self.features_col,
                           written_table(spark.createDataFrame(coded, "column int, slots binary, cuts binary"), "columns"),
                           written_table(spark.createDataFrame(table, "tree int, column binary, cut binary, left binary, part binary"), "tops"), parts)

    def _whole(self, spark, held: RDD, columns: Columns) -> DataFrame:
        """Every tree in a task of its own, which holds all rows."""
        found = held.collect()
        data = tuple(np.concatenate([b[i] for b in found], axis=-1) for i in range(3))
        data = tuple(x[..., np.argsort(data[2], kind="stable")] for x in data)     # in one order, whatever the partitions
        seed, bootstrap, least, depth = self.seed, self.bootstrap, self.least, self.depth
        sent = spark.sparkContext.broadcast((columns, *data))

        def run(batches):
            columns, codes, y, h = sent.value
            for b in batches:
                for t in b.column(0).to_pylist():
                    w = draws(h, seed, t, bootstrap)
                    on = w > 0
                    yield _batch([(t, 0, *grow(codes[:, on], y[on], w[on], columns, least, depth))])

        return spark.range(0, self.trees, 1, self.trees).mapInArrow(run, _PARTS)

    def _tops(self, held: RDD, columns: Columns, most: int) -> list[Tree]:
        """The nodes of more than ``most`` rows and their children, split by bins of codes."""
        bins = replace(columns, cuts=[None if v is None else np.arange(int(b.max())) for v, b in zip(columns.cuts, columns.coarse)])
        last = [np.searchsorted(b, np.arange(int(b.max()) + 1), side="right") - 1 for b in columns.coarse]   # a bin's last code
        widths, grouped, seed, bootstrap = bins.widths, columns.grouped, self.seed, self.bootstrap
        tops, live, level = [Tree() for _ in range(self.trees)], [(t, 0) for t in range(self.trees)], 0
        size = max(1, PASS_CELLS // sum(widths))
        while live and (self.depth is None or level < self.depth):
            following = []
            for at in range(0, len(live), size):
                pairs, by_tree = live[at:at + size], {}
                for i, (t, node) in enumerate(pairs):
                    by_tree.setdefault(t, []).append((node, i))
                arrays = {t: tops[t].arrays() for t in by_tree}

                def scan(part, by_tree=by_tree, arrays=arrays, n=len(pairs)):
                    total = np.zeros((2, n, sum(widths) + 1))
                    for codes, y, h in part:
                        coarse = np.stack([b[x] for b, x in zip(columns.coarse, codes)])
                        for t, nodes in by_tree.items():
                            w = draws(h, seed, t, bootstrap)
                            slot = np.full(len(arrays[t][0]), len(nodes), np.int64)
                            slot[[x for x, _ in nodes]] = np.arange(len(nodes))
                            node = slot[nodes_of(arrays[t], grouped, codes)]
                            node[w == 0] = len(nodes)
                            to = [i for _, i in nodes]
                            total[:, to, :-1] += histogram(node, coarse, widths, len(nodes), w * y, w)
                            total[0, to, -1] += np.bincount(node, w * y * y, len(nodes) + 1)[:-1]
                    yield total

                found = _added(held.mapPartitions(scan))
                for (t, i), best, hist in zip(pairs, best_splits(found[:, :, :-1], bins, lambda _: None, self.least), np.moveaxis(found, 1, 0)):
                    n, s = hist[:, :widths[0]].sum(axis=1)
                    tops[t].n[i], tops[t].value[i] = float(n), float(s / n) if n else 0.0
                    if hist[0, -1] * n - s * s <= 1e-12 * hist[0, -1] * n or best is None and _equal(hist[0], columns):
                        tops[t].ended.add(i)
                    if best is None or i in tops[t].ended:
                        continue
                    gain, column, cut, nl, sl, nr, sr = best
                    children = tops[t].grow(i, column, cut if grouped[column] else int(last[column][cut]), gain, [sl / nl, sr / nr], [nl, nr])
                    following += [(t, x) for x, k in zip(children, (nl, nr)) if k > most]
            live, level = following, level + 1
        return tops

    def _dealt(self, spark, held: RDD, columns: Columns, tops: list[Tree], n: int) -> DataFrame:
        """The parts, grown from the rows that fall into each; some trees' rows at once."""
        seed, bootstrap, least, depth = self.seed, self.bootstrap, self.least, self.depth
        grouped, tables = columns.grouped, []
        size = max(1, DEALT_BYTES // (n * (2 * len(columns.cuts) + 16)))
        depths = [_depths(t) for t in tops]
        ended = [set(_numbered(t)[sorted(t.ended)].tolist()) for t in tops]
        leaf = (np.array([-1], np.int16), np.zeros(1, np.uint16), np.zeros(1, np.int32))
        done = [(t, int(_numbered(tops[t])[i]), *(bytearray(x.tobytes()) for x in (*leaf, np.array([tops[t].value[i]]))))
                for t in range(self.trees) for i in sorted(tops[t].ended)]
        if done:
            tables.append(written_table(spark.createDataFrame(done, _PARTS), "forest"))
        for first in range(0, self.trees, size):
            some = {t: (tops[t].arrays(), _numbered(tops[t])) for t in range(first, min(first + size, self.trees))}
            sent = spark.sparkContext.broadcast((columns, some, depths))

            def deal(block):
                codes, y, h = block
                for t, (arrays, number) in sent.value[1].items():
                    w = draws(h, seed, t, bootstrap)
                    on = np.flatnonzero(w)
                    part = number[nodes_of(arrays, grouped, codes)[on]]
                    order = np.argsort(part, kind="stable")
                    found, starts = np.unique(part[order], return_index=True)
                    for p, rows in zip(found.tolist(), np.split(on[order], starts[1:])):
                        if p not in ended[t]:
                            yield (t, p), (codes[:, rows], y[rows], w[rows].astype(np.uint8), h[rows])

            def run(item):
                (t, part), given = item
                given = list(given)
                codes, y, w, h = (np.concatenate([g[i] for g in given], axis=-1) for i in range(4))
                order = np.argsort(h, kind="stable")
                above = sent.value[2][t][part]
                tree = grow(codes[:, order], y[order], w[order].astype(np.float64), sent.value[0], least, None if depth is None else depth - above)
                return (t, part, *(bytearray(x.tobytes()) for x in tree))

            keys = sum(int(x[1].max()) + 1 for x in some.values())
            tables.append(written_table(spark.createDataFrame(held.flatMap(deal).groupByKey(max(keys, spark.sparkContext.defaultParallelism))
                                                              .map(run), _PARTS), "forest"))
        out = tables[0]
        for x in tables[1:]:
            out = out.unionAll(x)
        return out


def _numbered(tree: Tree) -> np.ndarray:
    """Of each node the number of its part: leaves in turn, -1 elsewhere."""
    leaf = np.array(tree.column) < 0
    return np.where(leaf, np.cumsum(leaf) - 1, -1)


def _equal(n: np.ndarray, columns: Columns) -> bool:
    """Whether the rows of a node have one code in every column."""
    offset = 0
    for b in columns.coarse:
        width = int(b.max()) + 1
        used = np.flatnonzero(n[offset:offset + width])
        offset += width
        if len(used) != 1 or (b == used[0]).sum() != 1:
            return False
    return True


def _depths(tree: Tree) -> np.ndarray:
    """The depth of each part."""
    depth = [0] * len(tree.column)
    for i, c in enumerate(tree.column):
        if c >= 0:
            depth[tree.left[i]] = depth[tree.left[i] + 1] = depth[i] + 1
    return np.array(depth)[np.array(tree.column) < 0]
