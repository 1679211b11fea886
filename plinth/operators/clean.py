"""Feature cleaning: drop constant columns and the later column of near-copies.

Fit (optionally per group, e.g. all folds in one pass):
  1. constant rule: ``nunique(dropna=False) <= threshold``.  With threshold
     <= 1 this needs only count/NULL count/min/max per column (one
     aggregate, no shuffle of values); above 1 it counts the distinct values.
  2. correlation rule on the numeric columns left: for every pair (a, b),
     a before b, drop b when |pearson(a, b)| > threshold on the rows where
     both are present.  NULL correlations (constant pair) never drop.
The result is the sorted union.  Transform drops the names, ignoring
unknown ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from plinth.functions.exprs import is_numeric
from plinth.operators.correlate import later_columns
from plinth.operators.state import StateEstimator, StateModel
from plinth.operators.stats import distinct_counts, null_min_max


def constant_columns(df: DataFrame, cols: list[str], threshold: int = 1, group: str | None = None) -> dict:
    """{g: [columns with at most ``threshold`` distinct values, missing included]}."""
    if not cols:
        return {}
    out: dict = {}
    if threshold <= 1:
        for g, per_col in null_min_max(df, cols, group).items():
            keep = []
            for name, (n, missing, lo, hi) in per_col.items():
                nunique = (1 if missing else 0) + (0 if lo is None else (1 if lo == hi else 2))
                if n == 0 or nunique <= threshold:
                    keep.append(name)
            out[g] = keep
    else:
        for g, per_col in distinct_counts(df, cols, group).items():
            out[g] = [name for name in cols if per_col.get(name, 0) <= threshold]
    return out


def fit_cleaner(df: DataFrame, cols: list[str], drop_constant: bool = True, constant_threshold: int = 1,
                drop_correlated: bool = True, correlation_threshold: float = 0.995,
                group: str | None = None, groups: list | None = None) -> dict:
    """{g: sorted columns to drop}."""
    keys = groups if groups is not None else [None]
    drops = {g: [] for g in keys}
    if drop_constant:
        for g, names in constant_columns(df, cols, constant_threshold, group).items():
            drops.setdefault(g, []).extend(names)
    if drop_correlated:
        types = dict((f.name, f.dataType) for f in df.schema.fields)
        remaining = {g: [x for x in cols if x not in drops.get(g, []) and is_numeric(types[x])] for g in keys}
        for g, names in later_columns(df, remaining, correlation_threshold, group).items():
            drops.setdefault(g, []).extend(names)
    return {g: sorted(set(v)) for g, v in drops.items()}


class FeatureCleanerModel(StateModel):
    """Drops the fitted list (``drop``); unknown names are ignored."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.get("drop", []))


class FeatureCleaner(StateEstimator):
    """Estimator form of the cleaner over every column but the excluded ones: ``of(exclude=[...], drop_constant=...,
    constant_threshold=..., drop_correlated=..., correlation_threshold=...)``."""

    def _fit(self, dataset: DataFrame) -> FeatureCleanerModel:
        skip = set(self.get("exclude", []))
        names = ("drop_constant", "constant_threshold", "drop_correlated", "correlation_threshold")
        given = {k: self.get(k) for k in names if self.get(k) is not None}
        return FeatureCleanerModel.of(drop=fit_cleaner(dataset, [x for x in dataset.columns if x not in skip], **given)[None])
