"""Model registry: name + parameters -> an MLlib estimator.

Penalties are mapped exactly onto MLlib's objective.  Both solvers
standardize the label, so with n rows of the (transformed) training target
and s its std:

  ridge(alpha)               regParam = alpha * s / n,             elasticNetParam = 0
  lasso(alpha)               regParam = alpha,                     elasticNetParam = 1
  elasticnet(alpha, r)       regParam = alpha*r + alpha*(1-r)*s,   elasticNetParam = alpha*r / regParam

all with ``standardization=False`` (the features are scaled, if at all, by
the recipe).  The normal-equation solver (``normal``) takes the population
std, ``l-bfgs`` the sample std (n - 1).  ``normal`` is limited to 4096
features; wider inputs use ``l-bfgs``, which gives the same solution.  The
parameter ``solver`` chooses one explicitly.

Trees of MLlib: ``max_depth=None`` becomes 30, its largest depth; a larger
explicit depth is an error.  Forests over all slots are ``ForestRegressor`` and have
no limit.  The vendor boosting libraries are re-aimed at ``BoostedTreesRegressor``, or
MLlib's ``GBTRegressor`` for native categories.  Parameters without a counterpart are
logged as dropped.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.target import inverse_target, transform_target
from plinth.operators.forest import ForestRegressor
from plinth.operators.neighbours import NeighbourIndex
from plinth.operators.state import StageHolder
from plinth.operators.trees import BoostedTreesRegressor
from plinth.session import written_table

LINEAR = {"linear_regression", "ridge", "lasso", "elasticnet"}
TREES = {"decision_tree", "random_forest", "xgboost", "lightgbm", "catboost"}
SUPPORTED = LINEAR | TREES | {"knn"}
NORMAL_MAX_FEATURES = 4096
CODED_MAX_FEATURES = 1024          # wider vectors go to MLlib's own boosting and forests
MAX_TREE_DEPTH = 30
TIGHT_TOL = 1e-12


@dataclass(frozen=True)
class FitContext:
    """Facts about the training rows that exact penalty mapping needs."""
    n_rows: int
    target_std: float            # population std of the transformed target
    n_features: int = 1
    seed: int = 42
    max_bins: int = 32           # trees: at least the largest category count


def family(model_name: str) -> str:
    if model_name in LINEAR:
        return "linear"
    if model_name == "knn":
        return "knn"
    if model_name == "dnn":
        return "dnn"
    if model_name in TREES:
        return "tree"
    raise ValueError(f"no estimator is registered for {model_name!r}")


def needs_scaling(model_name: str, scale_linear: bool = True, scale_knn: bool = True) -> bool:
    fam = family(model_name)
    return {"linear": scale_linear, "knn": scale_knn, "dnn": True}.get(fam, False)


def native_categories(model_name: str) -> bool:
    """Whether the model takes categories as nominal indices instead of one-hot columns."""
    return model_name == "catboost"


def _depth(v) -> int:
    if v is not None and int(v) > MAX_TREE_DEPTH:
        raise ValueError(f"max_depth={v} is above {MAX_TREE_DEPTH}, the deepest tree MLlib grows")
    return MAX_TREE_DEPTH if v is None else int(v)


_log = logging.getLogger(__name__)
_KNOWN = {
    "linear": {"alpha", "l1_ratio", "fit_intercept", "max_iter", "solver", "random_state"},
    "knn": {"n_neighbors", "weights"},
    "decision_tree": {"max_depth", "min_samples_leaf", "random_state"},
    "random_forest": {"max_depth", "min_samples_leaf", "n_estimators", "random_state", "bootstrap", "max_features"},
    "xgboost": {"max_depth", "n_estimators", "learning_rate", "subsample", "colsample_bytree", "random_state"},
    "lightgbm": {"max_depth", "num_leaves", "n_estimators", "learning_rate", "subsample", "colsample_bytree", "random_state"},
    "catboost": {"depth", "iterations", "learning_rate", "random_state", "random_seed"},
}


def dropped_params(model_name: str, params: dict) -> list[str]:
    """Names that have no counterpart in the MLlib estimator."""
    known = _KNOWN.get("linear" if model_name in LINEAR else model_name, set(params))
    return sorted(set(params) - known)


def _subset(v) -> str:
    """MLlib's feature subset of a tree for ``max_features``."""
    if v is None or v in ("all", "auto") or (isinstance(v, float) and v == 1.0):
        return "all"
    return str(v)


def linear_params(model_name: str, params: dict, ctx: FitContext) -> dict:
    """LinearRegression keyword arguments for a sklearn-style linear model."""
    s = ctx.target_std or 0.0
    n = max(ctx.n_rows, 1)
    solver = params.get("solver", "auto")
    if solver not in ("normal", "l-bfgs"):         # another library's solver names give the same solution
        solver = "normal" if ctx.n_features <= NORMAL_MAX_FEATURES else "l-bfgs"
    if solver == "l-bfgs" and n > 1:
        s *= math.sqrt(n / (n - 1))
    kw = dict(standardization=False, fitIntercept=bool(params.get("fit_intercept", True)),
              solver=solver, tol=TIGHT_TOL, maxIter=int(params.get("max_iter", 1000) or 1000))
    if model_name == "linear_regression":
        return {**kw, "regParam": 0.0, "elasticNetParam": 0.0}
    alpha = float(params.get("alpha", 1.0))
    if s == 0.0:
        return {**kw, "regParam": 0.0, "elasticNetParam": 0.0}   # constant target: intercept only
    if model_name == "ridge":
        return {**kw, "regParam": alpha * s / n, "elasticNetParam": 0.0}
    if model_name == "lasso":
        return {**kw, "regParam": alpha, "elasticNetParam": 1.0}
    if model_name == "elasticnet":
        r = float(params.get("l1_ratio", 0.5))
        reg = alpha * r + alpha * (1 - r) * s
        return {**kw, "regParam": reg, "elasticNetParam": alpha * r / reg if reg > 0 else 0.0}
    raise ValueError(f"not a linear model: {model_name}")


def build_estimator(model_name: str, params: dict, ctx: FitContext, features_col: str = "features",
                    label_col: str = "label", id_col: str | None = None):
    """The MLlib estimator (or, for knn, the exact neighbour join) for one experiment on one set of training rows."""
    io = dict(featuresCol=features_col, labelCol=label_col, predictionCol="prediction")
    # split statistics per task are bounded by maxMemoryInMB (more passes instead of more memory);
    # cached node ids spare re-walking the growing trees on every level (same model)
    bins = dict(maxBins=max(32, int(ctx.max_bins)), maxMemoryInMB=128, cacheNodeIds=True)
    given = params.get("random_state", params.get("random_seed"))
    seed = int(ctx.seed if given is None else given)
    if lost := dropped_params(model_name, params):
        _log.warning("%s: no counterpart for %s", model_name, ", ".join(lost))
    if model_name in LINEAR:
        return LinearRegression(**io, **linear_params(model_name, params, ctx))
    if model_name == "decision_tree":
        return DecisionTreeRegressor(**io, **bins, maxDepth=_depth(params.get("max_depth")),
                                     minInstancesPerNode=int(params.get("min_samples_leaf", 1)), seed=seed)
    if model_name == "random_forest":
        trees, depth, least = int(params.get("n_estimators", 100)), params.get("max_depth"), int(params.get("min_samples_leaf", 1))
        subset, bootstrap = _subset(params.get("max_features")), bool(params.get("bootstrap", True))
        if ctx.n_features > CODED_MAX_FEATURES or subset != "all":
            return RandomForestRegressor(**io, **bins, numTrees=trees, maxDepth=_depth(depth), minInstancesPerNode=least,
                                         featureSubsetStrategy=subset, bootstrap=bootstrap, seed=seed)
        return ForestRegressor(trees, None if depth is None else int(depth), least, bootstrap, seed, features_col, label_col, id_col)
    if model_name in ("xgboost", "lightgbm"):
        depth = params.get("max_depth")
        if depth is not None and int(depth) <= 0:              # "no limit" in these libraries
            depth = None
        if depth is None and "num_leaves" in params:           # the depth that holds so many leaves
            depth = max(1, math.ceil(math.log2(int(params["num_leaves"]))))
        trees, step, depth = int(params.get("n_estimators", 100)), float(params.get("learning_rate", 0.1)), _depth(6 if depth is None else depth)
        share, columns = float(params.get("subsample", 1.0)), params.get("colsample_bytree", "all")
        if ctx.n_features > CODED_MAX_FEATURES or not (columns == "all" or isinstance(columns, float) and 0 < columns <= 1):
            return GBTRegressor(**io, **bins, maxIter=trees, stepSize=step, maxDepth=depth, subsamplingRate=share,
                                featureSubsetStrategy=str(columns), seed=seed)
        return BoostedTreesRegressor(trees, step, depth, share, 1.0 if columns == "all" else columns, seed, features_col=features_col, label_col=label_col,
                                     id_col=id_col)
    if model_name == "catboost":
        return GBTRegressor(**io, **bins, maxIter=int(params.get("iterations", 100)),
                            stepSize=float(params.get("learning_rate", 0.1)),
                            maxDepth=_depth(params.get("depth", 6)), seed=seed)
    if model_name == "dnn":
        raise ImportError("the neural-net regressor is not available on Spark in this engine")
    if model_name == "knn":
        return NearestNeighboursRegressor(params.get("n_neighbors", 5), params.get("weights", "uniform"), features_col, label_col,
                                          id_col=id_col)
    raise ValueError(f"no estimator is registered for {model_name!r}")


class TargetTransformModel(StageHolder, Model):
    def __init__(self, model, mode: str, prediction_col: str = "prediction"):
        super().__init__()
        self.model, self.mode, self.prediction_col = model, mode, prediction_col

    def settings(self) -> dict:
        return {"mode": self.mode, "prediction_col": self.prediction_col}

    def parts(self) -> dict:
        return {"model": self.model}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.model.transform(dataset)
        return out.withColumn(self.prediction_col, inverse_target(F.col(self.prediction_col), self.mode))


class TargetTransformRegressor(StageHolder, Estimator):
    """Fit any regressor on ``log1p(label)``; predictions come back through ``expm1``."""

    def __init__(self, estimator, mode: str = "log1p", label_col: str = "label"):
        super().__init__()
        self.estimator, self.mode, self.label_col = estimator, mode, label_col

    def settings(self) -> dict:
        return {"mode": self.mode, "label_col": self.label_col}

    def parts(self) -> dict:
        return {"estimator": self.estimator}

    def _fit(self, dataset: DataFrame) -> TargetTransformModel:
        moved = dataset.withColumn(self.label_col, transform_target(F.col(self.label_col), self.mode))
        return TargetTransformModel(self.estimator.fit(moved), self.mode)


class NearestNeighboursModel(StageHolder, Model):
    """Mean label of the nearest training rows; ``weights="distance"`` weighs them by 1 / distance
    (rows at distance 0 alone, if there are any).

    A saved model holds the training rows and builds its index again, which is exact, when it is used."""

    def __init__(self, train: DataFrame, k: int, weights: str, features_col: str, prediction_col: str = "prediction"):
        super().__init__()
        self.train, self.k, self.weights = train, k, weights
        self.features_col, self.prediction_col = features_col, prediction_col
        self._index: NeighbourIndex | None = None

    def settings(self) -> dict:
        return {"k": self.k, "weights": self.weights, "features_col": self.features_col, "prediction_col": self.prediction_col}

    def parts(self) -> dict:
        return {"train": self.train}

    @property
    def index(self) -> NeighbourIndex:
        if self._index is None:
            self._index = NeighbourIndex(self.train, self.k, "id", "vec", "y")
        return self._index

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = written_table(dataset.withColumn("__row", F.monotonically_increasing_id()), "scored")
        vectors = rows.select("__row", vector_to_array(F.col(self.features_col)).alias("vec"))
        found = self.index.search(vectors, "__row", "vec")
        label = F.avg("y")
        if self.weights == "distance":
            far = F.when(F.col("d2") > 0, 1 / F.sqrt("d2"))
            label = F.coalesce(F.avg(F.when(F.col("d2") == 0, F.col("y"))), F.sum(F.col("y") * far) / F.sum(far))
        means = found.groupBy("row").agg(label.alias(self.prediction_col)).withColumnRenamed("row", "__row")
        return rows.join(means, "__row", "left").drop("__row")


class NearestNeighboursRegressor(StageHolder, Estimator):
    """k-nearest-neighbour regression over Euclidean distance, exact; ties go to the smaller id, and to the
    smaller label where the rows have no id column."""

    def __init__(self, k: int = 5, weights: str = "uniform", features_col: str = "features", label_col: str = "label",
                 id_col: str | None = None):
        super().__init__()
        if weights not in ("uniform", "distance"):
            raise ValueError(f"unknown weights {weights!r}")
        self.k, self.weights, self.features_col, self.label_col, self.id_col = int(k), weights, features_col, label_col, id_col

    def settings(self) -> dict:
        return {"k": self.k, "weights": self.weights, "features_col": self.features_col, "label_col": self.label_col, "id_col": self.id_col}

    def _fit(self, dataset: DataFrame) -> NearestNeighboursModel:
        key = F.lit(0).cast("long") if self.id_col is None or self.id_col not in dataset.columns else F.col(self.id_col)
        rows = dataset.select(key.alias("id"), vector_to_array(F.col(self.features_col)).alias("vec"), F.col(self.label_col).alias("y"))
        model = NearestNeighboursModel(rows, self.k, self.weights, self.features_col)
        model.index                                     # noqa: B018, built with the fit
        return model
