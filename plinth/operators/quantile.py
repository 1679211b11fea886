"""Exact, distributed quantiles with linear interpolation, per column and group.

Built-in ``percentile``/``median`` keep a value->count map of a whole group inside one task; on a
large table that is unbounded.  Here a quantile is found in brackets:

1. One aggregate makes a mergeable sketch (``percentile_approx``) of each column and group; two
   of its ranks around each wanted one, further off than the sketch's error, are the bracket.
2. One pass counts the values below the bracket and keeps those inside, one row for each distinct
   value; what lies above is dropped.  So about ``4 / ACCURACY`` of the values are shuffled, and
   equal ones are summed before.
3. The values at the wanted ranks are selected from the rows kept: on the driver if they are at
   most DRIVER_ROWS, else by a range-partitioned running sum.

The counts tell whether a bracket held the wanted ranks; one that did not is opened to all values
and looked at again, so the result is exact whatever the sketch said.  The driver holds
#groups x #columns x #probabilities brackets.

Interpolation as pandas/DuckDB: ``h = (n - 1) p``, ``v[floor h] +
(h - floor h) (v[ceil h] - v[floor h])``.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions.exprs import c, nan_to_null
from plinth.operators.rank import prefix_sums_multi
from plinth.session import written_table

COLUMN, VALUE, PROB = "column", "value", "prob"
#: Ranks of a sketch; groups of at most KEEP_ALL values need none; rows that are selected from on the driver.
ACCURACY, KEEP_ALL, DRIVER_ROWS = 1000, 10_000, 100_000
_INF = float("inf")
#: Distances of a sketch's ranks from a wanted one, where the ranks of several sketches are added.
_STEPS = (0.0, 0.001, 0.002, 0.004, 0.008, 0.016, 0.032, 0.064, 0.125, 0.25)


def to_long(df: DataFrame, columns: list[str], group_cols: list[str] = ()) -> DataFrame:
    """(group..., column, value DOUBLE) for the non-missing cells of ``columns``."""
    cells = F.explode(F.array(*[F.struct(F.lit(name).alias(COLUMN), c(name).cast("double").alias(VALUE))
                                for name in columns])).alias("cell")
    long = df.select(*[c(g) for g in group_cols], cells).select(*group_cols, "cell.*")
    return long.filter(F.col(VALUE).isNotNull() & ~F.isnan(F.col(VALUE)))


def _sketches(columns: list[str], ranks: list[float]) -> list[Column]:
    """Count and values at ``ranks`` of each column, by a mergeable sketch."""
    values = [nan_to_null(c(x).cast("double")) for x in columns]
    return [*[F.count(v).alias(f"n{i}") for i, v in enumerate(values)],
            *[F.percentile_approx(v, ranks, ACCURACY).alias(f"q{i}") for i, v in enumerate(values)]]


def _bracket(n: int, found: list | None, i: int) -> tuple[float, float]:
    return (-_INF, _INF) if n <= KEEP_ALL or found is None else (found[2 * i], found[2 * i + 1])


def _added(parts: list[tuple], grid: np.ndarray, low: int, high: int) -> tuple[float, float]:
    """A bracket of the ranks ``low`` to ``high`` of several parts together, each given as (size, values at ``grid``)."""
    if sum(n for n, _ in parts) <= KEEP_ALL:
        return -_INF, _INF
    at = np.unique(np.concatenate([v for _, v in parts]))
    most, least = np.zeros(len(at)), np.zeros(len(at))                     # bounds of how many values are at most ``at``
    for n, v in parts:
        most += n * np.minimum(1, np.append(grid, 1)[np.searchsorted(v, at, "right")] + 1 / ACCURACY)
        least += n * np.maximum(0, np.insert(grid, 0, 0)[np.searchsorted(v, at, "right")] - 1 / ACCURACY)
    below, above = np.flatnonzero(most < low), np.flatnonzero(least > high + 1)
    return float(at[below[-1]]) if len(below) else -_INF, float(at[above[0]]) if len(above) else _INF


def _targets(n: int, p: float) -> tuple[int, int, float]:
    h = (n - 1) * p
    return math.floor(h), math.ceil(h), h - math.floor(h)


def _inside(long: DataFrame, keys: list[str], brackets: list[tuple], counts: list[Column]) -> DataFrame:
    """Written rows (keys..., prob, value, counts): the distinct values in each bracket, and one of null value
    for all below it."""
    fields = [*[f for f in long.schema.fields if f.name in keys], *[T.StructField(n, T.DoubleType()) for n in (PROB, "lo", "hi")]]
    fields.sort(key=lambda f: [*keys, PROB, "lo", "hi"].index(f.name))
    table = F.broadcast(long.sparkSession.createDataFrame(brackets, T.StructType(fields)))    # one row a key and prob
    met = long.join(table, keys).filter(F.col(VALUE) <= F.col("hi"))
    kept = F.when(F.col(VALUE) >= F.col("lo"), F.col(VALUE)).alias(VALUE)
    return written_table(met.groupBy(*[F.col(k) for k in keys], PROB, kept).agg(*counts), "brackets")


def _select(table: DataFrame, keys: list[str], weights: list[str], wanted: dict) -> dict:
    """{(key, j): (value, below, inside)} for wanted {(key, j): (lower rank, upper rank, fraction)}, where weight j
    counts; value is None if the rows kept don't hold both ranks."""
    below: dict = {}
    for r in table.filter(F.col(VALUE).isNull()).collect():                # one row for each key
        below[tuple(r[k] for k in keys)] = [r[w] for w in weights]
    inside = table.filter(F.col(VALUE).isNotNull())
    found: dict = {}
    if inside.count() <= DRIVER_ROWS:
        rows: dict = {}
        for r in inside.collect():
            rows.setdefault(tuple(r[k] for k in keys), []).append((r[VALUE], *[r[w] for w in weights]))
        totals = {k: [sum(v[j + 1] for v in some) for j in range(len(weights))] for k, some in rows.items()}
        for (key, j), (lo, hi, _) in wanted.items():
            at, seen, pair = below.get(key, [0] * len(weights))[j], 0, [None, None]
            for value, *n in sorted(rows.get(key, ())):
                for side, rank in enumerate((lo, hi)):
                    if at + seen <= rank < at + seen + n[j]:
                        pair[side] = value
                seen += n[j]
            found[key, j] = pair
    else:
        ranked, totals = prefix_sums_multi(inside, keys, VALUE, weights)
        lines = [(*key, j, lo - (b := below.get(key, [0] * len(weights))[j]), hi - b) for (key, j), (lo, hi, _) in wanted.items()]
        fields = sorted([f for f in inside.schema.fields if f.name in keys], key=lambda f: keys.index(f.name))
        schema = T.StructType([*fields, T.StructField("j", T.IntegerType()), T.StructField("r_lo", T.LongType()),
                               T.StructField("r_hi", T.LongType())])
        targets = F.broadcast(inside.sparkSession.createDataFrame(lines, schema))   # one row for each key, prob and weight
        at = F.col("j") + 1
        cum = F.element_at(F.array(*[F.col(f"cum_{w}") for w in weights]), at)
        start = cum - F.element_at(F.array(*[F.col(w) for w in weights]), at)
        hit = [(start <= F.col(r)) & (F.col(r) < cum) for r in ("r_lo", "r_hi")]
        picked = ranked.join(targets, keys).filter(hit[0] | hit[1]).groupBy(*keys, "j").agg(
            *[F.max(F.when(h, F.col(VALUE))).alias(n) for h, n in zip(hit, ("v_lo", "v_hi"), strict=True)])
        for r in picked.collect():
            found[tuple(r[k] for k in keys), r["j"]] = [r["v_lo"], r["v_hi"]]
    out = {}
    for (key, j), (_, _, frac) in wanted.items():
        lo, hi = found.get((key, j), (None, None))
        out[key, j] = None if lo is None or hi is None else lo + frac * (hi - lo)
    return out


def quantile_dict(df: DataFrame, columns: list[str], probs: list[float], group_cols: list[str] = (),
                  exact: bool = True, accuracy: int = 100_000) -> dict:
    """{(group..., column, prob): value}; a column without values has no entry.

    ``exact=False`` takes the sketch's own quantiles instead.
    """
    if not columns:
        return {}
    groups, probs = list(group_cols), [float(p) for p in probs]
    if not exact:
        values = [F.percentile_approx(nan_to_null(c(x).cast("double")), probs, accuracy).alias(f"q{i}") for i, x in enumerate(columns)]
        rows = df.groupBy(*groups).agg(*values).collect()
        return {(*[r[g] for g in groups], x, p): v for r in rows for i, x in enumerate(columns)
                for p, v in zip(probs, r[f"q{i}"] or [], strict=False)}
    ranks = [min(1.0, max(0.0, p + side * 2 / ACCURACY)) for p in probs for side in (-1, 1)]
    sizes, brackets = {}, {}
    for r in df.groupBy(*groups).agg(*_sketches(columns, ranks)).collect():
        for i, x in enumerate(columns):
            key = (*[r[g] for g in groups], x)
            sizes[key] = r[f"n{i}"]
            for k, p in enumerate(probs) if r[f"n{i}"] else ():
                brackets[*key, p] = _bracket(r[f"n{i}"], r[f"q{i}"], k)
    long, keys = to_long(df, columns, groups), [*groups, COLUMN]
    out: dict = {}
    while brackets:                                                        # a second time for brackets that missed
        table = _inside(long, keys, [(*k, *b) for k, b in brackets.items()], [F.count("*").alias("cnt")])
        ranks = {(k, 0): _targets(sizes[k[:-1]], k[-1]) for k in brackets}
        found = _select(table, [*keys, PROB], ["cnt"], ranks)
        out |= {k: v for (k, _), v in found.items() if v is not None}
        brackets = {k: (-_INF, _INF) for (k, _), v in found.items() if v is None and brackets[k] != (-_INF, _INF)}
    return out


def quantiles(df: DataFrame, columns: list[str], probs: list[float], group_cols: list[str] = (),
              exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """(group..., column, prob, value) for every column and probability (``quantile_dict`` as a table)."""
    groups = [f for g in group_cols for f in df.schema.fields if f.name == g]
    schema = T.StructType([*groups, T.StructField(COLUMN, T.StringType()), *[T.StructField(n, T.DoubleType()) for n in (PROB, VALUE)]])
    found = quantile_dict(df, columns, probs, group_cols, exact, accuracy)
    return df.sparkSession.createDataFrame([(*k, float(v)) for k, v in found.items()], schema)


def fold_quantiles(df: DataFrame, columns: list[str], probs: list[float], fold_col: str, all_folds: list,
                   folds: list) -> dict:
    """{f: {col: {prob: value}}} on each fold's training rows (fold != f), exact, without copying rows:
    a sketch of each fold, whose ranks add up to those of the training rows; one bracket of a column
    and probability that covers those of all folds; and a count for each fold on every value kept."""
    fold, probs = F.col(fold_col), [float(p) for p in probs]
    out: dict = {f: {} for f in folds}
    if not columns:
        return out
    grid = sorted({min(1.0, max(0.0, p + side * step)) for p in probs for side in (-1, 1) for step in _STEPS} | {0.0, 1.0})
    sizes: dict = {(x, f): 0 for x in columns for f in folds}
    known: dict = {x: {} for x in columns}
    for r in df.groupBy(fold.alias("__fold")).agg(*_sketches(columns, grid)).collect():
        for i, x in enumerate(columns):
            if r[f"n{i}"]:
                known[x][r["__fold"]] = (r[f"n{i}"], np.array(r[f"q{i}"]))
    brackets: dict = {}
    for x in columns:
        for f in folds:
            some = [v for g, v in known[x].items() if g != f]
            sizes[x, f] = sum(n for n, _ in some)
            for p in probs if some else ():
                lo, hi = _added(some, np.array(grid), *_targets(sizes[x, f], p)[:2])
                was = brackets.get((x, p), (lo, hi))
                brackets[x, p] = (min(lo, was[0]), max(hi, was[1]))
    names = [f"w{j}" for j in range(len(folds))]
    counts = [F.count_if(fold != f).alias(n) for n, f in zip(names, folds, strict=True)]
    long = to_long(df, columns, [fold_col])
    while brackets:
        table = _inside(long, [COLUMN], [(*k, *b) for k, b in brackets.items()], counts)
        ranks = {((x, p), j): _targets(sizes[x, f], p) for x, p in brackets for j, f in enumerate(folds)
                 if sizes[x, f] and p not in out[f].get(x, {})}
        found = _select(table, [COLUMN, PROB], names, ranks)
        for ((x, p), j), v in found.items():
            if v is not None:
                out[folds[j]].setdefault(x, {})[p] = v
        brackets = {k: (-_INF, _INF) for (k, _), v in found.items() if v is None and brackets[k] != (-_INF, _INF)}
    return out
