"""Linear models of one training set from its sufficient statistics.

One pass over the prepared rows gives the cross products of features and target; every penalty
of every linear experiment on those rows is then solved from them on the driver, and one
projection scores the rows of all experiments.  A grid of any size costs two passes a fold.

The objectives are those of the estimators in ``models``:
  ridge             |y - Xw|^2 + alpha |w|^2, by Cholesky (least squares of least norm where the
                    matrix is singular and alpha is 0)
  lasso, elasticnet |y - Xw|^2 / 2n + alpha r |w|_1 + alpha (1 - r) |w|^2 / 2, by coordinate descent
with an intercept unless ``fit_intercept`` is false.

Each task sends one row for each feature: MAX_FEATURES vectors of MAX_FEATURES numbers at most,
summed by row number, so no reducer holds a matrix and the driver holds one.  Wider inputs and
experiments that ask for a solver keep the estimators.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.plans.models import LINEAR
from plinth.session import ship_package

#: Features of a Gram matrix (8 MB); rows of a matrix product.
MAX_FEATURES, ROWS = 1024, 1024
_SWEEPS, _TIGHT = 10_000, 1e-12


def eligible(model_name: str, params: dict, n_features: int) -> bool:
    return model_name in LINEAR and "solver" not in params and n_features <= MAX_FEATURES


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def moments_of(rows: DataFrame, features: str, label: str, width: int) -> np.ndarray:
    """The (width + 2)^2 cross products of (1, features, label) over all rows."""
    found = moments_by(rows.withColumn("__group", F.lit(0)), features, label, width, "__group")
    return found.get(0, np.zeros((width + 2, width + 2)))


def moments_by(rows: DataFrame, features: str, label: str, width: int, group: str) -> dict[int, np.ndarray]:
    """The cross products of each value of ``group``, a whole number of few values (folds)."""
    ship_package(rows.sparkSession)
    size = width + 2

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                z = np.ones((part.num_rows, size))
                z[:, 1:-1] = _matrix(part.column(0), width)
                z[:, -1] = part.column(1).to_numpy(zero_copy_only=False)
                groups = part.column(2).to_numpy(zero_copy_only=False)
                for g in np.unique(groups).tolist():
                    of = z[groups == g]
                    total[g] = total.get(g, 0.0) + of.T @ of
        for g, t in total.items():
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, size * size + 1, size), pa.int32()), pa.array(t.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(size, g), pa.int32()), pa.array(np.arange(size), pa.int32()), lists], ["g", "i", "v"])

    parts = rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"), F.col(group).cast("int").alias("g"))
    parts = parts.mapInArrow(products, "g int, i int, v array<double>").select("g", "i", array_to_vector("v").alias("v"))
    out: dict[int, np.ndarray] = {}
    for g, i, v in parts.groupBy("g", "i").agg(Summarizer.sum(F.col("v")).alias("v")).collect():   # size rows a group
        out.setdefault(g, np.zeros((size, size)))[i] = v.toArray()
    return out


def _descent(g: np.ndarray, b: np.ndarray, l1: float, l2: float, sweeps: int) -> np.ndarray:
    """argmin w'gw / 2 - b'w + l1 |w|_1 + l2 |w|^2 / 2, one coordinate after the other."""
    w, slope = np.zeros(len(b)), b.copy()                                  # slope = b - g w
    own = np.diag(g)
    for _ in range(sweeps):
        most = 0.0
        for j in range(len(b)):
            if own[j] + l2 <= 0:
                continue
            near = slope[j] + own[j] * w[j]
            new = np.sign(near) * max(abs(near) - l1, 0.0) / (own[j] + l2)
            if new != w[j]:
                slope -= g[:, j] * (new - w[j])
                most = max(most, abs(new - w[j]) * np.sqrt(own[j]))
                w[j] = new
        if most <= _TIGHT * max(1.0, np.abs(w).max(initial=0.0)):
            break
    return w


def solve(products: np.ndarray, model_name: str, params: dict) -> tuple[float, np.ndarray]:
    """(intercept, coefficients) of one experiment."""
    n = products[0, 0]
    if n < 1:
        raise ValueError("no training rows")
    means = products[0] / n if params.get("fit_intercept", True) else np.zeros(len(products))
    s = products - n * np.outer(means, means)
    g, b, x_means = s[1:-1, 1:-1], s[1:-1, -1], means[1:-1]
    flat = np.diag(g) <= 1e-12 * np.maximum(np.diag(products)[1:-1], 1e-300)   # constant columns get no weight
    g, b = np.where(flat[:, None] | flat, 0.0, g), np.where(flat, 0.0, b)
    alpha = float(params.get("alpha", 1.0)) if model_name != "linear_regression" else 0.0
    if model_name in ("linear_regression", "ridge"):
        try:
            w = np.linalg.solve(np.linalg.cholesky(m := g + alpha * np.eye(len(b))), b)
            w = np.linalg.solve(np.linalg.cholesky(m).T, w)
        except np.linalg.LinAlgError:
            w = np.linalg.lstsq(g + alpha * np.eye(len(b)), b, rcond=1e-12)[0]
    else:
        share = 1.0 if model_name == "lasso" else float(params.get("l1_ratio", 0.5))
        sweeps = max(_SWEEPS, int(params.get("max_iter", 0) or 0))
        w = _descent(g / n, b / n, alpha * share, alpha * (1 - share), sweeps)
    return float(means[-1] - x_means @ w), w


def predict(rows: DataFrame, features: str, key: str, models: dict[str, tuple[float, np.ndarray]], prediction: str) -> DataFrame:
    """(key, experiment, prediction): every row under every model."""
    names = list(models)
    weights = np.stack([models[n][1] for n in names], 1)
    start = np.array([models[n][0] for n in names])

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _matrix(batch.column(1), len(weights)) @ weights + start
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, found.size + 1, len(names)), pa.int32()), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [key, "p"])

    kind = rows.schema[key].dataType.simpleString()
    scored = rows.select(key, vector_to_array(features).alias("x")).mapInArrow(score, f"`{key}` {kind}, p array<double>")
    return scored.select(key, F.posexplode("p").alias("at", prediction)).select(
        key, F.element_at(F.array(*[F.lit(n) for n in names]), F.col("at") + 1).alias("experiment"), prediction)
