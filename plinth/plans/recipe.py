"""Recipes: the preprocessing in front of a model, fitted for many folds at once.

Order of stages (as the original pipeline): cleaner -> clipper ->
numeric branch (impute, optionally scale) + categorical branch (impute,
one-hot) -> vector.  ``fit_recipe`` fits the statistics of every stage for
all groups (folds) in one aggregate per stage over the fold-stacked rows;
``recipe_stages`` turns one group's state into ``pyspark.ml`` transformers.
Column sets may differ by fold (the cleaner is fitted per fold), so feature
vectors of different folds are never mixed - only predictions are.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.exprs import c, is_numeric
from plinth.operators.categories import categories, fold_categories
from plinth.operators.clean import FeatureCleanerModel, fit_cleaner
from plinth.operators.prep import (ClipModel, ImputeModel, ScaleModel, clip_grouped, fit_categorical_fill,
                                   fit_clip_bounds, fit_numeric_fill, fit_scaler, impute_grouped, index_stages,
                                   onehot_stages)
from plinth.operators.state import by_group
from plinth.spec import PrepSpec

FEATURES = "features"
# The token for a missing category, one-hot recipe and native-category recipe.
ONEHOT_TOKEN, NATIVE_TOKEN = "missing_value", "Missing"


def _prep_for(prep: PrepSpec, encode: bool) -> tuple[PrepSpec, str]:
    """The settings a recipe uses and its token: native categories always take the median and the token."""
    if encode:
        return prep, ONEHOT_TOKEN
    return replace(prep, numeric_imputer_strategy="median", categorical_imputer_strategy="constant"), NATIVE_TOKEN


@dataclass
class RecipeState:
    drop: list = field(default_factory=list)
    clip: dict | None = None
    num_fill: dict = field(default_factory=dict)
    cat_fill: dict = field(default_factory=dict)
    scale: dict | None = None
    cats: dict = field(default_factory=dict)
    numeric: list = field(default_factory=list)
    categorical: list = field(default_factory=list)
    encode: bool = True

    @property
    def n_features(self) -> int:
        return len(self.numeric) + (sum(len(v) for v in self.cats.values()) if self.encode else len(self.categorical))

    @property
    def max_categories(self) -> int:
        return max([len(v) + 1 for v in self.cats.values()], default=2)

    def only(self, columns: list[str]) -> RecipeState:
        """The state of some of its columns; no statistic but the test for correlation looks at another column."""
        some = lambda given: {x: v for x, v in given.items() if x in columns}
        return RecipeState(drop=[x for x in self.drop if x in columns], clip=some(self.clip) if self.clip is not None else None,
                           num_fill=some(self.num_fill), cat_fill=some(self.cat_fill),
                           scale=some(self.scale) if self.scale is not None else None, cats=some(self.cats),
                           numeric=[x for x in self.numeric if x in columns],
                           categorical=[x for x in self.categorical if x in columns], encode=self.encode)


def fit_recipe(df: DataFrame, feature_cols: list[str], prep: PrepSpec, scale: bool, group: str | None = None,
               groups: list | None = None, encode: bool = True) -> dict:
    """{g: RecipeState} for every group of ``df[group]`` (or {None: ...})."""
    prep, token = _prep_for(prep, encode)
    keys = groups if groups is not None else [None]
    gcol = None if group is None else F.col(group)
    types = {f.name: f.dataType for f in df.schema.fields}
    drops = fit_cleaner(df, feature_cols, prep.drop_constant_features, prep.constant_threshold_unique,
                        prep.drop_correlated_features, prep.correlation_threshold, group, keys)
    kept = {g: [x for x in feature_cols if x not in drops[g]] for g in keys}
    num_union = [x for x in feature_cols if is_numeric(types[x]) and any(x in kept[g] for g in keys)]
    cat_union = [x for x in feature_cols if not is_numeric(types[x]) and any(x in kept[g] for g in keys)]

    bounds = None
    work = df
    if prep.clip_outliers and num_union:
        bounds = fit_clip_bounds(df, num_union, prep.outlier_lower_quantile, prep.outlier_upper_quantile, group,
                                 prep.exact_quantiles, prep.approx_accuracy)
        work = clip_grouped(df, bounds, group)
    num_fill = fit_numeric_fill(work, num_union, prep.numeric_imputer_strategy, group, prep.exact_quantiles,
                                prep.approx_accuracy, keys)
    cat_fill = fit_categorical_fill(work, cat_union, prep.categorical_imputer_strategy, group, keys, token)
    scale_state = None
    if scale and num_union:
        live = [x for x in num_union if all(num_fill[g].get(x) is not None for g in keys)]
        imputed = impute_grouped(work, {g: {x: num_fill[g][x] for x in live} for g in keys}, group)
        scale_state = fit_scaler(imputed, live, group) if live else {g: {} for g in keys}
    cats = {g: {} for g in keys}
    if cat_union:
        filled = work.withColumns({x: F.coalesce(c(x).cast("string"),
                                                 by_group(gcol, {g: cat_fill[g].get(x) for g in keys}, "string"))
                                   for x in cat_union})
        cats = categories(filled, cat_union, group)
    out = {}
    for g in keys:
        numeric = [x for x in num_union if x in kept[g] and num_fill[g].get(x) is not None]
        categorical = [x for x in cat_union if x in kept[g] and cat_fill[g].get(x) is not None]
        out[g] = RecipeState(
            drop=drops[g], clip=(bounds or {}).get(g), num_fill={x: num_fill[g][x] for x in num_union if x in kept[g]},
            cat_fill={x: cat_fill[g][x] for x in cat_union if x in kept[g]},
            scale=({x: v for x, v in scale_state[g].items() if x in numeric} if scale_state else None),
            cats={x: cats.get(g, {}).get(x, []) for x in categorical}, numeric=numeric, categorical=categorical,
            encode=encode)
    return out


def recipe_stages(state: RecipeState, sample: DataFrame, features_col: str = FEATURES) -> list:
    """Transformers for one group's state (cleaner, clipper, imputer, scaler, one-hot, vector)."""
    stages = [FeatureCleanerModel.of(drop=state.drop)]
    if state.clip:
        stages.append(ClipModel.of(bounds={x: b for x, b in state.clip.items() if x in state.numeric}))
    stages.append(ImputeModel.of(numeric=state.num_fill, categorical=state.cat_fill))
    if state.scale:
        stages.append(ScaleModel.of(scale=state.scale))
    inputs = list(state.numeric)
    probe = PipelineModel(stages).transform(sample.limit(0))
    if state.encode:
        oh, oh_cols = onehot_stages(probe, state.cats)
        stages += oh
        inputs += oh_cols
    else:
        idx, idx_cols = index_stages(state.cats)
        stages += idx
        inputs += idx_cols
    stages.append(VectorAssembler(inputCols=inputs, outputCol=features_col, handleInvalid="error"))
    return stages


def add_scaler(df: DataFrame, states: dict, group: str | None = None) -> dict:
    """Copies of fitted states with a standard scaler on their imputed numeric columns."""
    keys = list(states)
    gcol = None if group is None else F.col(group)
    work = df
    first = states[keys[0]]
    if first.clip is not None:
        work = clip_grouped(df, {g: states[g].clip for g in keys}, group)
    live = [x for x in first.num_fill if all(states[g].num_fill.get(x) is not None for g in keys)]
    if not live:
        return {g: replace(states[g], scale={}) for g in keys}
    imputed = impute_grouped(work, {g: {x: states[g].num_fill[x] for x in live} for g in keys}, group)
    fitted = fit_scaler(imputed, live, group)
    return {g: replace(states[g], scale={x: v for x, v in fitted[g].items() if x in states[g].numeric})
            for g in keys}


def fit_recipe_folds(df: DataFrame, feature_cols: list[str], prep: PrepSpec, fold_col: str, folds: list,
                     encode: bool = True) -> dict:
    """{f: RecipeState} fitted on each fold's training rows (all rows whose fold is not f).

    Additive statistics (constant test, correlations, value counts for modes
    and categories) are aggregated once per fold and combined; the exact medians
    come from per-fold counts.  Clipping, a distinct-count threshold above 1 or a
    non-median numeric strategy fall back to copied (row x training fold) rows
    for every stage.
    """
    from plinth.operators.split import FOLD as _FOLD, TRAIN_FOLD, training_rows
    from plinth.operators.correlate import later_columns
    from plinth.operators.stats import fold_null_min_max
    given, (prep, token) = prep, _prep_for(prep, encode)
    n_splits = len(folds) if len(folds) > 1 else 1
    stacked = training_rows(df.withColumnRenamed(fold_col, _FOLD) if fold_col != _FOLD else df, n_splits)
    if prep.clip_outliers or prep.constant_threshold_unique > 1 or prep.numeric_imputer_strategy != "median":
        return fit_recipe(stacked, feature_cols, given, False, TRAIN_FOLD, folds, encode=encode)
    types = {f.name: f.dataType for f in df.schema.fields}
    drops = {f: [] for f in folds}
    if prep.drop_constant_features:
        nmm = fold_null_min_max(df, feature_cols, fold_col, folds)
        for f in folds:
            for x, (n, missing, lo, hi) in nmm[f].items():
                nunique = (1 if missing else 0) + (0 if lo is None else (1 if lo == hi else 2))
                if n == 0 or nunique <= prep.constant_threshold_unique:
                    drops[f].append(x)
    if prep.drop_correlated_features:
        remaining = {f: [x for x in feature_cols if x not in drops[f] and is_numeric(types[x])] for f in folds}
        for f, later in later_columns(df, remaining, prep.correlation_threshold, fold_col, folds, feature_cols).items():
            drops[f] += later
    drops = {f: sorted(set(v)) for f, v in drops.items()}
    kept = {f: [x for x in feature_cols if x not in drops[f]] for f in folds}
    num_union = [x for x in feature_cols if is_numeric(types[x]) and any(x in kept[f] for f in folds)]
    cat_union = [x for x in feature_cols if not is_numeric(types[x]) and any(x in kept[f] for f in folds)]
    if prep.exact_quantiles and num_union:
        from plinth.operators.quantile import fold_quantiles
        all_folds = list(folds) if len(folds) > 1 else [0, 1]
        q = fold_quantiles(df, num_union, [0.5], fold_col, all_folds, folds)
        num_fill = {f: {x: q[f].get(x, {}).get(0.5) for x in num_union} for f in folds}
    else:
        num_fill = fit_numeric_fill(stacked, num_union, "median", TRAIN_FOLD, prep.exact_quantiles,
                                    prep.approx_accuracy, folds)
    cat_fill = {f: {} for f in folds}
    cats = {f: {} for f in folds}
    if cat_union:
        frequent = prep.categorical_imputer_strategy == "most_frequent"
        for f, found in fold_categories(df, cat_union, fold_col, folds, None if frequent else token).items():
            cat_fill[f] = {x: fill for x, (fill, _) in found.items()}
            cats[f] = {x: values for x, (_, values) in found.items()}
    out = {}
    for f in folds:
        numeric = [x for x in num_union if x in kept[f] and num_fill[f].get(x) is not None]
        categorical = [x for x in cat_union if x in kept[f] and cat_fill[f].get(x) is not None]
        out[f] = RecipeState(drop=drops[f], clip=None, num_fill={x: num_fill[f][x] for x in num_union if x in kept[f]},
                             cat_fill={x: cat_fill[f][x] for x in cat_union if x in kept[f]}, scale=None,
                             cats={x: cats[f].get(x, []) for x in categorical}, numeric=numeric,
                             categorical=categorical, encode=encode)
    return out


def add_scaler_folds(df: DataFrame, states: dict, fold_col: str) -> dict:
    """Scaler per fold from per-fold moments, the missing cells counted at that fold's fill value."""
    from plinth.operators.stats import fold_moments
    folds = list(states)
    if any(states[f].clip for f in folds):
        raise ValueError("clipped recipes take the exploded path")
    live = [x for x in states[folds[0]].num_fill if all(states[f].num_fill.get(x) is not None for f in folds)]
    if not live:
        return {f: replace(states[f], scale={}) for f in folds}
    mom = fold_moments(df, live, fold_col, folds, fills={f: states[f].num_fill for f in folds})
    out = {}
    for f in folds:
        scale = {}
        for x in live:
            n, mu, sp, _ = mom[f][x]
            scale[x] = [mu if mu is not None else 0.0, sp if sp is not None and sp > 0 else 1.0]
        out[f] = replace(states[f], scale={x: v for x, v in scale.items() if x in states[f].numeric})
    return out
