"""Column statistics fitted in one pass, optionally per group (e.g. per fold).

Every function takes an optional ``group`` column; the result is a dict
keyed by the group value (``None`` when ungrouped).  Results are small:
#groups x #columns numbers, collected to the driver as fitted state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.exprs import c, nan_to_null
from plinth.operators.quantile import COLUMN, PROB, VALUE, quantile_dict

GROUP = "__group"


def _grouped(df: DataFrame, group: str | None) -> tuple[DataFrame, list]:
    # ungrouped data is one group with key 0 (a NULL key would not join); see _key
    if group is None:
        return df.withColumn(GROUP, F.lit(0)), [GROUP]
    return df.withColumnRenamed(group, GROUP) if group != GROUP else df, [GROUP]


def _key(group: str | None, value):
    return None if group is None else value


def _collect_by_group(agg_df: DataFrame, group: str | None) -> dict:
    return {_key(group, r[GROUP]): r.asDict() for r in agg_df.collect()}


def null_min_max(df: DataFrame, cols: list[str], group: str | None = None) -> dict:
    """{g: {col: (n_rows, n_missing, min, max)}} - enough for the constant rule."""
    gdf, keys = _grouped(df, group)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, name in enumerate(cols):
        v = nan_to_null(c(name)) if dict(df.dtypes)[name] in ("double", "float") else c(name)
        aggs += [F.count_if(v.isNull()).alias(f"m{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    out = {}
    for g, row in _collect_by_group(gdf.groupBy(*keys).agg(*aggs), group).items():
        out[g] = {name: (row["__n"], row[f"m{i}"], row[f"lo{i}"], row[f"hi{i}"]) for i, name in enumerate(cols)}
    return out


def distinct_counts(df: DataFrame, cols: list[str], group: str | None = None) -> dict:
    """{g: {col: number of distinct values, missing counted as one value}}, exact at any size.

    Long form (group, column, value as text) -> distinct -> count: map-side
    partial aggregation collapses hot values before the shuffle.
    """
    gdf, keys = _grouped(df, group)
    types = dict(df.dtypes)

    def text(name):
        v = c(name)
        if types[name] in ("double", "float"):
            v = nan_to_null(v) + F.lit(0.0)       # -0.0 and 0.0 are one value
        return v.cast("string")

    cells = F.explode(F.array(*[F.struct(F.lit(n).alias(COLUMN), text(n).alias(VALUE)) for n in cols]))
    long = gdf.select(*keys, cells.alias("cell")).select(*keys, "cell.*")
    per_col = long.select(*keys, COLUMN, VALUE).distinct().groupBy(*keys, COLUMN).count()
    out: dict = {}
    for r in per_col.collect():
        out.setdefault(_key(group, r[GROUP]), {})[r[COLUMN]] = r["count"]
    return out


def moments(df: DataFrame, cols: list[str], group: str | None = None) -> dict:
    """{g: {col: (count, mean, stddev_pop, stddev_samp)}} of the non-missing values."""
    gdf, keys = _grouped(df, group)
    aggs = []
    for i, name in enumerate(cols):
        v = nan_to_null(c(name).cast("double"))
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mu{i}"),
                 F.stddev_pop(v).alias(f"sp{i}"), F.stddev_samp(v).alias(f"ss{i}")]
    out = {}
    for g, row in _collect_by_group(gdf.groupBy(*keys).agg(*aggs), group).items():
        out[g] = {name: (row[f"n{i}"], row[f"mu{i}"], row[f"sp{i}"], row[f"ss{i}"]) for i, name in enumerate(cols)}
    return out


def quantiles_by_group(df: DataFrame, cols: list[str], probs: list[float], group: str | None = None,
                       exact: bool = True, accuracy: int = 100_000) -> dict:
    """{g: {col: {prob: value}}}; a column with no value has no entry."""
    gdf, keys = _grouped(df, group)
    raw = quantile_dict(gdf, cols, probs, keys, exact, accuracy)
    out: dict = {}
    for (g, col, p), v in raw.items():
        out.setdefault(_key(group, g), {}).setdefault(col, {})[p] = v
    return out


def modes(df: DataFrame, cols: list[str], group: str | None = None, as_text: bool = True) -> dict:
    """{g: {col: most frequent non-missing value}}, ties to the smallest value."""
    if not cols:
        return {}
    gdf, keys = _grouped(df, group)
    cast = "string" if as_text else "double"
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias(COLUMN), c(n).cast(cast).alias(VALUE)) for n in cols]))
    long = gdf.select(*keys, cells.alias("cell")).select(*keys, "cell.*").filter(F.col(VALUE).isNotNull())
    counts = long.groupBy(*keys, COLUMN, VALUE).agg(F.count(F.lit(1)).alias("cnt"))
    best = counts.groupBy(*keys, COLUMN).agg(
        F.min_by(VALUE, F.struct(-F.col("cnt"), F.col(VALUE))).alias("mode"))
    out: dict = {}
    for r in best.collect():
        out.setdefault(_key(group, r[GROUP]), {})[r[COLUMN]] = r["mode"]
    return out


__all__ = ["GROUP", "null_min_max", "distinct_counts", "moments", "quantiles_by_group", "modes",
           "PROB", "VALUE", "COLUMN"]


# ---------------------------------------------------------------------------
# Per-fold training statistics without exploding rows.
#
# The training rows of fold f are all rows whose fold is not f.  Additive
# statistics are aggregated once per fold (one pass, each row once) and the
# training-fold values are combined on the driver from the other folds:
# counts and sums add, min/max take min/max, moments merge with Chan's
# parallel formula.


def _merge_moments(parts: list[tuple[int, float, float]]) -> tuple[int, float | None, float | None]:
    """(n, mean, M2) of the union of groups given as (n, mean, M2)."""
    n, mean, m2 = 0, 0.0, 0.0
    for nb, mb, m2b in parts:
        if not nb:
            continue
        if n == 0:
            n, mean, m2 = nb, mb, m2b
            continue
        tot = n + nb
        delta = mb - mean
        mean = mean + delta * nb / tot
        m2 = m2 + m2b + delta * delta * n * nb / tot
        n = tot
    return (n, mean, m2) if n else (0, None, None)


def fold_null_min_max(df: DataFrame, cols: list[str], fold_col: str, folds: list) -> dict:
    per = null_min_max(df, cols, fold_col)
    out = {}
    for f in folds:
        others = [per[g] for g in per if g != f]
        out[f] = {}
        for x in cols:
            n = sum(o[x][0] for o in others)
            miss = sum(o[x][1] for o in others)
            los = [o[x][2] for o in others if o[x][2] is not None]
            his = [o[x][3] for o in others if o[x][3] is not None]
            out[f][x] = (n, miss, min(los) if los else None, max(his) if his else None)
    return out


def fold_moments(df: DataFrame, cols: list[str], fold_col: str, folds: list, fills: dict | None = None) -> dict:
    """{f: {col: (count, mean, stddev_pop, stddev_samp)}} on fold f's training rows.

    With ``fills`` ({f: {col: value}}), missing cells count as that fold's fill
    value (the moments of the imputed column), added analytically.
    """
    gdf = df.withColumnRenamed(fold_col, GROUP)
    aggs = []
    for i, name in enumerate(cols):
        v = nan_to_null(c(name).cast("double"))
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"mu{i}"), F.var_pop(v).alias(f"vp{i}")]
    aggs.append(F.count(F.lit(1)).alias("__rows"))
    rows = {r[GROUP]: r for r in gdf.groupBy(GROUP).agg(*aggs).collect()}
    out = {}
    for f in folds:
        others = [rows[g] for g in rows if g != f]
        out[f] = {}
        for i, x in enumerate(cols):
            parts = [(o[f"n{i}"], o[f"mu{i}"] or 0.0, (o[f"vp{i}"] or 0.0) * o[f"n{i}"]) for o in others]
            n, mean, m2 = _merge_moments(parts)
            if fills is not None and fills[f].get(x) is not None:
                missing = sum(o["__rows"] for o in others) - n
                n, mean, m2 = _merge_moments([(n, mean or 0.0, m2 or 0.0), (missing, float(fills[f][x]), 0.0)])
            if not n:
                out[f][x] = (0, None, None, None)
                continue
            sp = (m2 / n) ** 0.5
            ss = (m2 / (n - 1)) ** 0.5 if n > 1 else None
            out[f][x] = (n, mean, sp, ss)
    return out
