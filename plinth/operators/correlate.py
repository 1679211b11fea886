"""Pairwise-complete Pearson correlations of any number of columns, in tiles of TILE columns.

For two columns a and b, six sums over the rows where both are present give the correlation: the
number of rows, the sums of a and of b, of their squares and of a * b.  For two tiles each sum is one
matrix product of a task's rows.

A table of at most TILE columns is one tile.  A wider one is written once with one array column for
each tile; panel i is a pass over the tiles from i on (column pruning reads no other) in which a task
keeps the sums of tile i with each of them: 6 * 8 * TILE * p bytes for each group.  What leaves a task
is one vector for each (group, tile, tile); vectors are added by ``Summarizer`` in two levels, and the
correlations of a tile pair are worked out where its sums meet.  So no task, reducer or driver holds
p x p numbers, and the cleaner's driver gets the columns to drop only.  Tasks of a wide table read at
least 16 p rows each, so that the sums they send are a fraction of what they read.

``folds``: the training rows of fold f are those of the other groups, so their sums are the total
minus f's own; no row is copied.

Sums are taken from values less the column's mean (of the group, or of all rows with folds).  A column
or pair without variance, or with fewer than two common rows, has a NULL correlation.  Rows whose
group is NULL belong to no group.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.exprs import c, nan_to_null
from plinth.operators.stats import GROUP
from plinth.session import ship_package, temporary_table

TILE = 128                       # columns of a tile: six sums of a tile pair are 0.8 MB
BATCH = 4 << 20                  # bytes of values in one Arrow batch
SALT = 256                       # reducers that the sums of one tile pair are spread over first
SUMS = 6
LEFT, RIGHT, CORR = "left", "right", "abs_corr"


@contextmanager
def _small_batches(spark: SparkSession, rows: int):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if not 0 < int(before) <= rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _tiles(cols: list[str]) -> list[list[str]]:
    return [cols[i:i + TILE] for i in range(0, len(cols), TILE)]


def _laid_out(df: DataFrame, cols: list[str], group: str | None) -> DataFrame:
    """(group, t0, t1, ...): each tile's values as one array, NULL and NaN as NULL."""
    key = F.lit(0).cast("long") if group is None else c(group).cast("long")
    arrays = [F.array(*[nan_to_null(c(x).cast("double")) for x in tile]).alias(f"t{i}") for i, tile in enumerate(_tiles(cols))]
    out = df.select(key.alias(GROUP), *arrays)
    return out if group is None else out.filter(F.col(GROUP).isNotNull())


def _values(batches: Iterable) -> Iterator:
    """(group, rows x columns array) of each batch and group; NaN where a value is missing."""
    import numpy as np
    for batch in batches:
        if not batch.num_rows:
            continue
        groups = batch.column(0).to_numpy(zero_copy_only=False)
        x = np.hstack([batch.column(j).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                       for j in range(1, batch.num_columns)]).astype("float64", copy=False)
        for g in np.unique(groups):
            yield int(g), x[groups == g]


def _record(names: list[str], keys: tuple, vector):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays([*[pa.array([k], pa.int64()) for k in keys],
                                       pa.array([vector.ravel()], pa.list_(pa.float64()))], names)


def _added(df: DataFrame, keys: list[str]) -> DataFrame:
    """The vectors ``m`` of equal keys added, first by (keys, task mod SALT)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    parts = df.select(*keys, (F.spark_partition_id() % SALT).alias("__salt"), array_to_vector("m").alias("m"))
    for level in ([*keys, "__salt"], keys):
        parts = parts.groupBy(*level).agg(Summarizer.sum(F.col("m")).alias("m"))
    return parts.select(*keys, vector_to_array("m").alias("m"))


def _means(vals: DataFrame, p: int) -> tuple[dict, dict]:
    """({group: its rows}, {group: (present counts, means)}): 2 p + 1 numbers for each group."""
    import numpy as np

    def run(batches):
        acc: dict = {}
        for g, x in _values(batches):
            there = ~np.isnan(x)
            v = np.concatenate([[len(x)], there.sum(0), np.where(there, x, 0.0).sum(0)])
            acc[g] = acc[g] + v if g in acc else v
        for g, v in acc.items():
            yield _record([GROUP, "m"], (g,), v)

    rows, means = {}, {}
    for r in _added(vals.mapInArrow(run, f"{GROUP} long, m array<double>"), [GROUP]).collect():
        v = np.asarray(r["m"])
        n, total = v[1:p + 1], v[p + 1:]
        with np.errstate(all="ignore"):
            mean = np.where((n > 0) & np.isfinite(total), total / n, 0.0)
        rows[r[GROUP]], means[r[GROUP]] = int(v[0]), (n, mean)
    return rows, means


def _panel(vals: DataFrame, tile: int, widths: list[int], shifts: dict) -> DataFrame:
    """(group, i, j, m): each task's six sums of tile i = ``tile`` with every tile j from it on."""
    import numpy as np
    width, starts, first = widths[tile], np.cumsum([0, *widths[tile:]]), sum(widths[:tile])

    def run(batches):
        acc: dict = {}
        for g, x in _values(batches):
            x = x - shifts[g][first:]
            there = ~np.isnan(x)
            if there.all():
                left = x[:, :width]
                ones = np.ones((width, x.shape[1]))
                v = np.stack([len(x) * ones, ones * left.sum(0)[:, None], ones * x.sum(0),
                              ones * (left * left).sum(0)[:, None], ones * (x * x).sum(0), left.T @ x])
            else:
                x, m = np.where(there, x, 0.0), there.astype("float64")
                left, ml, sq = x[:, :width], m[:, :width], x * x
                v = np.stack([ml.T @ m, left.T @ m, ml.T @ x, sq[:, :width].T @ m, ml.T @ sq, left.T @ x])
            if g in acc:
                acc[g] += v
            else:
                acc[g] = v
        for g, v in acc.items():
            for j, (lo, hi) in enumerate(zip(starts[:-1], starts[1:]), tile):
                yield _record([GROUP, "i", "j", "m"], (g, tile, j), v[:, :, lo:hi])

    columns = [f"t{j}" for j in range(tile, len(widths))]
    return vals.select(GROUP, *columns).mapInArrow(run, f"{GROUP} long, i long, j long, m array<double>")


def _abs_corr(sums):
    """|r| from the six sums, NaN where it has no value."""
    import numpy as np
    n, sl, sr, ql, qr, cross = sums
    with np.errstate(all="ignore"):
        den = (ql - sl * sl / n) * (qr - sr * sr / n)
        return np.where((n >= 2) & (den > 0), np.abs(cross - sl * sr / n) / np.sqrt(den), np.nan)


def _correlated(vals: DataFrame, cols: list[str], folds: list | None, found, schema: str) -> DataFrame:
    """``found(group, lefts, rights, |r| matrix)`` of every group (or training fold) and tile pair i <= j."""
    import numpy as np
    import pyarrow as pa
    spark, tiles = vals.sparkSession, _tiles(cols)
    widths = [len(t) for t in tiles]
    rows, means = _means(vals, len(cols))
    shifts = {g: mean for g, (_, mean) in means.items()}
    if folds is not None and shifts:
        counts = sum(n for n, _ in means.values())
        total = sum(n * mean for n, mean in means.values())
        shifts = dict.fromkeys(shifts, np.divide(total, counts, out=np.zeros(len(cols)), where=counts > 0))
    read = vals
    if len(tiles) > 1:
        read = vals.coalesce(max(1, math.ceil(sum(rows.values()) / (16 * len(cols)))))
    sums = _added(reduce(DataFrame.union, [_panel(read, i, widths, shifts) for i in range(len(tiles))]), [GROUP, "i", "j"])
    fields = spark.createDataFrame([], schema).schema

    def finish(table):
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        lefts, rights = np.asarray(tiles[i], dtype=object), np.asarray(tiles[j], dtype=object)
        own = {g.as_py(): np.asarray(m.values).reshape(SUMS, len(lefts), len(rights))
               for g, m in zip(table.column(GROUP), table.column("m"))}
        if folds is not None:
            total = sum(own.values())
            own = {f: total - own.get(f, 0.0) for f in folds}
        parts = []
        for g, v in own.items():
            r = _abs_corr(v)
            if i == j:
                r = np.where(np.triu(np.ones(r.shape, dtype=bool), 1), r, -1.0)
            parts += found(g, lefts, rights, r)
        names = [f.name for f in fields]
        types = [{"bigint": pa.int64(), "string": pa.string(), "double": pa.float64()}[f.dataType.simpleString()] for f in fields]
        columns = list(zip(*parts)) if parts else [()] * len(names)
        return pa.table([pa.array(v, t) for v, t in zip(columns, types)], names=names)

    return sums.groupBy("i", "j").applyInArrow(finish, schema)


def _pairs(g, lefts, rights, r):
    at = (r != -1.0).nonzero()
    return [(g, a, b, None if v != v else float(v)) for a, b, v in zip(lefts[at[0]], rights[at[1]], r[at])]


@contextmanager
def _source(df: DataFrame, cols: list[str], group: str | None):
    """The laid out values, written for the time of the passes if there are several panels."""
    ship_package(df.sparkSession)
    with _small_batches(df.sparkSession, max(16, BATCH // (8 * len(cols)))):
        vals = _laid_out(df, cols, group)
        with temporary_table(vals, "tiles") if len(cols) > TILE else nullcontext(vals) as rows:
            yield rows


def _key(group: str | None, value):
    return None if group is None else value


def pair_correlations(df: DataFrame, cols: list[str], group: str | None = None, folds: list | None = None) -> dict:
    """{g: {(a, b): |pearson|}} for a before b in ``cols``: all pairs, for tables of few columns."""
    out: dict = {}
    place = {x: i for i, x in enumerate(cols)}
    with _source(df, cols, group) as vals:
        rows = _correlated(vals, cols, folds, _pairs, f"{GROUP} long, left string, right string, abs_corr double").collect()
    for r in sorted(rows, key=lambda r: (place[r[LEFT]], place[r[RIGHT]])):
        out.setdefault(_key(group, r[GROUP]), {})[r[LEFT], r[RIGHT]] = r[CORR]
    return out


def later_columns(df: DataFrame, allowed: dict, threshold: float, group: str | None = None, folds: list | None = None,
                  order: list[str] | None = None) -> dict:
    """{g: [every column b with |pearson(a, b)| > ``threshold`` for a column a before it]}, in ``order`` (that of
    ``df`` if not given); a and b are among ``allowed[g]``.  Correlations are compared at 12 decimals."""
    import numpy as np
    given = {g: set(names) for g, names in allowed.items()}
    cols = [x for x in order or df.columns if any(x in names for names in given.values())]
    if len(cols) < 2:
        return {g: [] for g in allowed}
    sets = {0 if group is None else g: names for g, names in given.items()}

    def found(g, lefts, rights, r):
        names = sets.get(g, set())
        mine = [np.array([x in names for x in side], dtype=bool) for side in (lefts, rights)]
        with np.errstate(all="ignore"):
            near = (r > threshold - 1e-11) & mine[0][:, None] & mine[1]
        a, b = near.nonzero()
        return [(g, x) for x in sorted({rights[y] for x, y in zip(a, b) if round(float(r[x, y]), 12) > threshold})]

    with _source(df, cols, group) as vals:
        rows = _correlated(vals, cols, folds, found, f"{GROUP} long, right string").distinct().collect()
    hit = {(_key(group, r[GROUP]), r[RIGHT]) for r in rows}
    return {g: [x for x in cols if (g, x) in hit] for g in allowed}
