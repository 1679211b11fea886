"""Cross-validation of an experiment grid with out-of-fold predictions, and refits.

Plan of one run:
  * ``base``: features + transformed target + one fold column per fold count, written once as
    Parquet so fold ids and statistics never shift and a statistic reads only its columns.
  * the row key travels in a reserved column, in its own type, that no stage touches; so the id
    may be a feature as well.
  * per fold count and recipe kind (scaled / unscaled): every stage's
    statistics for all folds in one pass over the fold-stacked training rows.
  * per fold, the linear experiments of a recipe are solved from one Gram matrix of the fold's
    training rows (``gram``); per other experiment and fold: ``Estimator.fit`` on those rows.
    Jobs are submitted from a small driver thread pool.
  * all predictions are unioned into one long table (id, experiment, fold,
    prediction) and written once under the shared work folder.
  * scores are one aggregate over that table.
"""

from __future__ import annotations

import copy
import logging
import threading
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.exprs import c
from plinth.functions.hashing import experiment_name
from plinth.functions.metrics import RMSE, Metric
from plinth.functions.target import transform_target
from plinth.operators.features import add_features
from plinth.operators.forest import ForestRegressor
from plinth.operators.split import (FOLD, LABEL, TRAIN_FOLD, fold_ids, fold_train, fold_valid, split_labelled,
                                    stratify_labels, training_rows)
from plinth.operators.stats import fold_moments, moments
from plinth.operators.trees import BoostedTreesRegressor
from plinth.plans import gram
from plinth.plans.models import FitContext, build_estimator, dropped_params, family, native_categories, needs_scaling
from plinth.plans.recipe import (FEATURES, add_scaler, add_scaler_folds, fit_recipe, fit_recipe_folds,
                                 recipe_stages)
from plinth.session import work_path, written_table
from plinth.spec import Spec

_log = logging.getLogger(__name__)
LABEL_COL, PRED = "label", "prediction"
KEY = "__row_key"          # the id as given; stages only see feature columns


@dataclass(frozen=True)
class Experiment:
    model_name: str
    params: tuple = ()

    @property
    def params_dict(self) -> dict:
        return dict(self.params)

    @property
    def name(self) -> str:
        return experiment_name(self.model_name, self.params_dict)


@dataclass
class ExperimentResult:
    experiment_name: str
    model_name: str
    params: dict
    primary_score: float
    fold_scores: dict
    score_kind: str = "mean_fold_rmse"
    fitted: bool = False


@dataclass
class RunLog:
    errors: list = field(default_factory=list)      # (experiment, stage, message)


def iter_experiments(spec: Spec) -> list[Experiment]:
    """Enabled models x their parameter sets, in spec order."""
    return [Experiment(m.name, tuple(p)) for m in spec.models if m.enabled for p in m.grids]


def feature_columns(df: DataFrame, spec: Spec) -> list[str]:
    skip = {spec.data.target_col, LABEL_COL, KEY}
    if not spec.data.id_as_feature:
        skip.add(spec.data.id_col)
    return [x for x in df.columns if x not in skip]


def fold_col(k: int) -> str:
    return f"{FOLD}_{k}"


#: Cells (rows x columns) of a partition that MLlib scans: its vectors take some hundred MB at most.
PARTITION_CELLS = 8_000_000


def training_partitions(spark: SparkSession, df: DataFrame) -> int:
    """Partitions for tables that MLlib scans repeatedly: at least one per core, and as many as
    keep each under PARTITION_CELLS, so partition size stays bounded as the data grows.  (File
    splits say little: a compressed column is many times wider as part of a vector.)"""
    cells = df.count() * len(df.columns)
    return max(spark.sparkContext.defaultParallelism, -(-cells // PARTITION_CELLS))


def make_folds(train: DataFrame, spec: Spec) -> DataFrame:
    """(id, fold_k for every compared fold count), written once."""
    d, v = spec.data, spec.validation
    out = stratify_labels(train.select(d.id_col, d.target_col), d.target_col, d.id_col, v.stratify_bins)
    for k in v.compare_n_splits:                  # the labels don't depend on the fold count
        out = split_labelled(out, d.id_col, k, spec.seed, v.single_split_valid_size,
                             v.shuffle).withColumnRenamed(FOLD, fold_col(k))
    return written_table(out.drop(LABEL, d.target_col), "folds")


def check_key(df: DataFrame, id_col: str) -> None:
    """Joins by id need ids that are unique and not null: an error names one that isn't."""
    n = F.count(F.lit(1))
    bad = df.groupBy(c(id_col)).agg(n.alias("__n")).filter(c(id_col).isNull() | (F.col("__n") > 1)).limit(1).collect()
    if bad:
        raise ValueError(f"{id_col}={bad[0][0]!r} occurs in {bad[0][1]} rows; ids must be unique and not null")


class CrossValidation:
    """Holds the written base table and fitted recipes of one training set."""

    def __init__(self, spark: SparkSession, train: DataFrame, spec: Spec, test: DataFrame | None = None,
                 folds: DataFrame | None | bool = None, encode: bool | None = None, materialized: bool = False):
        """``folds``: None = assign here; a frame (id, fold_k...) from ``make_folds`` = reuse it;
        False = no folds (refits only).  ``encode``: None = one-hot or nominal categories as the
        model takes them; True or False = the same for every model."""
        self.spark, self.spec, self.encode = spark, spec.validate(), encode
        d = spec.data
        feat = add_features(train, spec.features)
        self.features = feature_columns(feat, spec)
        labelled = feat.withColumns({LABEL_COL: transform_target(c(d.target_col), d.target_transform),
                                     KEY: c(d.id_col)})
        if not materialized:
            labelled = written_table(labelled, "labelled")    # one scan of the sources
        check_key(labelled, d.id_col)
        if folds is None:
            folds = make_folds(labelled, spec)
        # ML stages scan the base many times: spread it over every core; both sides of the join
        # come in the same partitioning, so the rows move once
        n_parts = self.n_parts = training_partitions(spark, labelled)
        rows = labelled.repartition(n_parts, c(d.id_col))
        if folds is not False:
            rows = rows.join(folds.repartition(n_parts, c(d.id_col)), d.id_col)
        self.base = written_table(rows, "base")
        self.test = None
        if test is not None:
            check_key(test, d.id_col)
            self.test = written_table(add_features(test, spec.features).withColumn(KEY, c(d.id_col))
                                      .repartition(n_parts, c(d.id_col)), "test")
        self._recipes: dict = {}
        self._targets: dict = {}
        self._prepared: dict = {}
        self._fitted_on: CrossValidation | None = None      # whose statistics hold this one's columns
        self._lock = threading.Lock()
        self._fit_lock = threading.RLock()      # statistics are computed once, whoever asks first
        self.log = RunLog()

    def on(self, features: list[str]) -> CrossValidation:
        """The same written rows, folds and targets with some of the features: recipes, prepared rows
        and errors are its own."""
        other = copy.copy(self)
        other.features, other.log = list(features), RunLog()
        other._recipes, other._prepared, other._fitted_on = {}, {}, None
        other._lock, other._fit_lock = threading.Lock(), threading.RLock()
        return other

    def on_each(self, features: list[str]) -> list[CrossValidation]:
        """``on`` each feature alone.  A column alone has none to be correlated with, and all other
        statistics are a column's own: those of all features are fitted in the same passes."""
        whole = self.on(list(dict.fromkeys(features)))
        whole.spec = replace(self.spec, prep=replace(self.spec.prep, drop_correlated_features=False))
        members = [self.on([x]) for x in features]
        for m in members:
            m._fitted_on = whole
        return members

    # ------------------------------------------------------------ fitted state
    def recipes(self, k: int | None, scale: bool, encode: bool = True) -> dict:
        with self._fit_lock:
            return self._fit_recipes(k, scale, encode)

    def _fit_recipes(self, k: int | None, scale: bool, encode: bool) -> dict:
        key = (k, scale, encode)
        if key not in self._recipes and self._fitted_on is not None:
            whole = self._fitted_on.recipes(k, scale, encode)
            self._recipes[key] = {g: state.only(self.features) for g, state in whole.items()}
        if key not in self._recipes:
            prep = self.spec.prep
            folded_path = k is not None and not prep.clip_outliers
            if k is None:
                data, group, groups = self.base, None, None
            else:
                data = training_rows(self.base.withColumnRenamed(fold_col(k), FOLD), k)
                group, groups = TRAIN_FOLD, fold_ids(k)
            if scale:     # everything but the scaler is shared with the unscaled recipe
                plain = self.recipes(k, False, encode)
                if folded_path:
                    self._recipes[key] = add_scaler_folds(self.base, plain, fold_col(k))
                else:
                    self._recipes[key] = add_scaler(data, plain, group)
            elif folded_path:
                self._recipes[key] = fit_recipe_folds(self.base, self.features, prep, fold_col(k), fold_ids(k),
                                                      encode=encode)
            else:
                self._recipes[key] = fit_recipe(data, self.features, prep, False, group, groups, encode=encode)
        return self._recipes[key]

    def target_stats(self, k: int | None) -> dict:
        """{fold: (n, mean, std_pop)} of the transformed target on each fold's training rows."""
        with self._fit_lock:
            if k not in self._targets:
                m = moments(self.base, [LABEL_COL]) if k is None else \
                    fold_moments(self.base, [LABEL_COL], fold_col(k), fold_ids(k))
                self._targets[k] = {g: v[LABEL_COL][:3] for g, v in m.items()}
            return self._targets[k]

    def _ctx(self, k: int | None, f, state) -> FitContext:
        n, _, s = self.target_stats(k)[f]
        return FitContext(n_rows=n, target_std=s or 0.0, n_features=state.n_features, seed=self.spec.seed,
                          max_bins=state.max_categories)

    # ------------------------------------------------------------------ fits
    def prepared(self, k: int | None, f, scale: bool, encode: bool = True, keep: bool = True):
        """(state, prep model, prepared rows) of one fold and recipe kind, persisted once and
        shared by every experiment that uses it (released by ``release``).  Without ``keep`` the rows
        are not persisted: for users that take each row once."""
        key = (k, f, scale, encode)
        with self._lock:
            if key not in self._prepared:
                state = self.recipes(k, scale, encode)[f]
                prep = PipelineModel(recipe_stages(state, self.base))
                kept = [F.col(KEY), F.col(LABEL_COL), F.col(FEATURES)] + \
                    [F.col(x) for x in self.base.columns if x.startswith(f"{FOLD}_")]
                base = self.base
                # a read packs the base's files anew into few large splits: rows that are scanned often
                # are dealt out again, as raw columns, which are narrower than the vectors
                if keep and base.rdd.getNumPartitions() < self.n_parts:
                    base = base.repartition(self.n_parts, F.col(KEY))
                rows = prep.transform(base).select(*kept)
                if not keep:
                    return state, prep, rows
                self._prepared[key] = (state, prep, rows.persist(StorageLevel.MEMORY_AND_DISK))
            return self._prepared[key]

    def release(self, key=None) -> None:
        with self._lock:
            for k in ([key] if key is not None else list(self._prepared)):
                if k in self._prepared:
                    self._prepared.pop(k)[2].unpersist()

    def _scale(self, exp: Experiment) -> bool:
        return needs_scaling(exp.model_name, self.spec.prep.scale_numeric_for_linear,
                             self.spec.prep.scale_numeric_for_knn)

    def _encode(self, exp: Experiment) -> bool:
        return not native_categories(exp.model_name) if self.encode is None else self.encode

    def _key(self) -> Column:
        return F.col(KEY).alias(self.spec.data.id_col)

    def fit_fold(self, exp: Experiment, k: int, f: int, with_test: bool = False):
        """(validation predictions, optional test predictions) of one experiment on one fold."""
        state, prep, prepared = self.prepared(k, f, self._scale(exp), self._encode(exp))
        est = build_estimator(exp.model_name, exp.params_dict, self._ctx(k, f, state), id_col=KEY)
        model = est.fit(fold_train(prepared, f, k, fold_col(k)))
        valid = (model.transform(fold_valid(prepared, f, fold_col(k)))
                 .select(self._key(), F.lit(exp.name).alias("experiment"), F.lit(f).alias(FOLD), F.col(PRED)))
        test = None
        if with_test and self.test is not None:
            full = PipelineModel([prep, model])
            test = (full.transform(self.test)
                    .select(self._key(), F.lit(exp.name).alias("experiment"), F.lit(f).alias(FOLD), F.col(PRED)))
        return valid, test

    def fit_fold_linear(self, exps: list[Experiment], k: int, f: int, with_test: bool = False, keep: bool = True):
        """As ``fit_fold`` for linear experiments of one recipe, from one pass over the training rows
        and one over the others; also {name: error} of those that can't be solved."""
        state, prep, prepared = self.prepared(k, f, self._scale(exps[0]), self._encode(exps[0]), keep)
        products = gram.moments_of(fold_train(prepared, f, k, fold_col(k)), FEATURES, LABEL_COL, state.n_features)
        models, errors = {}, {}
        for e in exps:
            try:
                models[e.name] = gram.solve(products, e.model_name, e.params_dict)
            except Exception as exc:  # one failing experiment does not stop the others
                errors[e.name] = f"{type(exc).__name__}: {exc}"
            if lost := dropped_params(e.model_name, e.params_dict):
                _log.warning("%s: no counterpart for %s", e.model_name, ", ".join(lost))
        if not models:
            return None, None, errors
        sides = [fold_valid(prepared, f, fold_col(k))]
        if with_test and self.test is not None:
            sides.append(prep.transform(self.test))
        valid, *test = [gram.predict(x, FEATURES, KEY, models, PRED).select(self._key(), "experiment", F.lit(f).alias(FOLD), F.col(PRED))
                        for x in sides]
        return valid, test[0] if test else None, errors

    def fit_full(self, exp: Experiment) -> tuple[PipelineModel, DataFrame | None]:
        """Refit on all training rows; predictions for the test rows (id, experiment, prediction)."""
        recipe = (self._scale(exp), self._encode(exp))
        est = build_estimator(exp.model_name, exp.params_dict, self._ctx(None, None, self.recipes(None, *recipe)[None]), id_col=KEY)
        _, prep, prepared = self.prepared(None, None, *recipe, keep=not isinstance(est, (BoostedTreesRegressor, ForestRegressor)))
        model = est.fit(prepared)
        full = PipelineModel([prep, model])
        preds = None
        if self.test is not None:
            preds = full.transform(self.test).select(self._key(), F.lit(exp.name).alias("experiment"), F.col(PRED))
        return full, preds

    def truth(self) -> DataFrame:
        """(id, label) of the training rows."""
        return self.base.select(self._key(), F.col(LABEL_COL))

    # ------------------------------------------------------------- the grid
    def evaluate(self, experiments: list[Experiment], with_fold_test: bool = False):
        """Run every experiment x fold count x fold.

        Linear experiments are solved together from Gram matrices, the others fitted one by one.
        Returns (results, oof, fold_test): ``oof`` is the written long table
        (id, prediction, experiment, fold) of the primary fold count;
        ``fold_test`` the fold models' test predictions (or None).  Each fit
        writes its own predictions, so a fold's prepared rows are released
        as soon as its last experiment is done.
        """
        v = self.spec.validation
        for exp in experiments:                      # fail early on unknown names
            try:
                family(exp.model_name)
            except ValueError as err:
                self.log.errors.append((exp.name, "build", str(err)))
        runnable = [e for e in experiments if not any(err[0] == e.name for err in self.log.errors)]
        for k in sorted(set(v.compare_n_splits)):     # statistics first, shared by all experiments
            for e in runnable:
                self.recipes(k, self._scale(e), self._encode(e))
            self.target_stats(k)
        roots = {k: work_path(self.spark, f"oof_{k}") for k in v.compare_n_splits}
        test_root = work_path(self.spark, "fold_test")
        # fold-major order: the prepared rows of a fold are released once its last fit is done; the
        # linear experiments of a fold and recipe are one job
        jobs = []
        for k in v.compare_n_splits:
            for f in fold_ids(k):
                together: dict = {}
                for e in runnable:
                    recipe = (self._scale(e), self._encode(e))
                    linear = gram.eligible(e.model_name, e.params_dict, self.recipes(k, *recipe)[f].n_features)
                    together.setdefault(recipe if linear else e.name, []).append(e)
                jobs += [(exps, k, f, isinstance(at, tuple)) for at, exps in together.items()]
        pending: dict = {}
        for exps, k, f, _ in jobs:
            key = (k, f, self._scale(exps[0]), self._encode(exps[0]))
            pending[key] = pending.get(key, 0) + 1
        uses = dict(pending)
        d = self.spec.data

        def run(job):
            exps, k, f, linear = job
            e = exps[0]
            key = (k, f, self._scale(e), self._encode(e))
            folder, errors = f"linear_{int(key[2])}{int(key[3])}" if linear else e.name, {}
            try:
                tests = with_fold_test and k == v.primary_n_splits
                if linear:
                    valid, test, errors = self.fit_fold_linear(exps, k, f, with_test=tests, keep=uses[key] > 1)
                else:
                    valid, test = self.fit_fold(e, k, f, with_test=tests)
                for side, root in ((valid, roots[k]), (test, test_root)):
                    if side is not None:
                        side.select(d.id_col, "experiment", PRED).write.mode("overwrite").parquet(f"{root}/job={folder}/{FOLD}={f}")
            except Exception as exc:  # one failing experiment does not stop the grid
                errors = {x.name: f"{type(exc).__name__}: {exc}" for x in exps}
            with self._lock:
                pending[key] -= 1
                last = pending[key] == 0
            if last:
                self.release(key)
            return [(name, k, f, err) for name, err in errors.items()]

        with ThreadPoolExecutor(max_workers=max(1, self.spec.parallelism)) as pool:
            done = list(pool.map(run, jobs))
        failed = {name for errors in done for name, *_ in errors}
        for name, k, f, err in (x for errors in done for x in errors):
            self.log.errors.append((name, f"fold {k}/{f}", err))
        good = [e.name for e in runnable if e.name not in failed]
        results, oof, fold_test = [], None, None
        truth = self.truth()
        per_k = {}
        for k in v.compare_n_splits:
            if good:
                per_k[k] = (self.spark.read.parquet(roots[k]).filter(F.col("experiment").isin(good))
                            .select(c(d.id_col), F.col("experiment"),
                                    F.col(FOLD).cast("int").alias(FOLD), F.col(PRED)))
        if v.primary_n_splits in per_k:
            oof = per_k[v.primary_n_splits]
        if with_fold_test and good:
            fold_test = (self.spark.read.parquet(test_root).filter(F.col("experiment").isin(good))
                         .select(c(d.id_col), F.col("experiment"),
                                 F.col(FOLD).cast("int").alias(FOLD), F.col(PRED)))
        scores = {}
        for k, table in per_k.items():
            for r in fold_scores(table, truth, d.id_col, v.metric, d.target_transform).collect():
                scores.setdefault(r["experiment"], {}).setdefault(k, []).append(_number(r["score"]))
        for e in runnable:
            if e.name in failed or e.name not in scores or v.primary_n_splits not in scores[e.name]:
                continue
            means = {k: sum(sc) / len(sc) for k, sc in scores[e.name].items()}
            results.append(ExperimentResult(e.name, e.model_name, e.params_dict, means[v.primary_n_splits], means,
                                            f"mean_fold_{v.metric.name}"))
        return results, oof, fold_test


def _number(score) -> float:
    """A metric without a value (no row counts) is not a number."""
    return float("nan") if score is None else float(score)


def fold_scores(oof: DataFrame, truth: DataFrame, id_col: str, metric: Metric = RMSE, transform: str = "none") -> DataFrame:
    """(experiment, fold, score) of validation predictions against the transformed target."""
    return (oof.join(truth, id_col).groupBy("experiment", FOLD)
            .agg(metric.of(F.col(LABEL_COL), F.col(PRED), transform).alias("score")))
