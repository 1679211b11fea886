from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression

from plinth.plans import gram
from plinth.plans.cv import CrossValidation, Experiment
from plinth.plans.models import FitContext, linear_params
from plinth.sources.fixture import ID, TARGET, train_test
from plinth.spec import fixture_spec


def data(n=300, p=6, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * rng.uniform(0.5, 4, p) + rng.normal(size=p)
    x[:, -1] = (x[:, 0] > 0)
    y = x[:, 0] - 0.5 * x[:, 1] + 0.1 * rng.normal(size=n) + 12
    return x, y


GRID = [("linear_regression", {}), ("ridge", {"alpha": 3.0}), ("ridge", {"alpha": 0.5, "fit_intercept": False}),
        ("lasso", {"alpha": 0.05, "max_iter": 10000}), ("elasticnet", {"alpha": 0.1, "l1_ratio": 0.3, "max_iter": 10000})]


@pytest.mark.parametrize(("model", "params"), GRID)
def test_solutions_match_the_estimators(spark, model, params):
    x, y = data()
    df = spark.createDataFrame([(Vectors.dense(a), float(b)) for a, b in zip(x, y)], ["features", "label"]).repartition(5)
    products = gram.moments_of(df, "features", "label", x.shape[1])
    z = np.column_stack([np.ones(len(y)), x, y])
    assert np.allclose(products, z.T @ z, rtol=1e-12)
    b, w = gram.solve(products, model, params)
    ctx = FitContext(n_rows=len(y), target_std=float(y.std()), n_features=x.shape[1])
    fit = LinearRegression(**linear_params(model, params, ctx)).fit(df)
    assert np.allclose(w, fit.coefficients.toArray(), atol=2e-6) and b == pytest.approx(fit.intercept, abs=2e-5)


def test_singular_and_constant_columns():
    x, y = data()
    for extra in (x[:, :1] * 2, np.full((len(y), 1), 3.0)):
        z = np.column_stack([np.ones(len(y)), x, extra, y])
        base = np.column_stack([np.ones(len(y)), x, y])
        for model, params in GRID[:2]:
            b, w = gram.solve(z.T @ z, model, params)
            assert np.isfinite(w).all()
            if model == "linear_regression":
                c, v = gram.solve(base.T @ base, model, params)
                assert np.allclose(z[:, 1:-1] @ w + b, x @ v + c, atol=1e-6)
    with pytest.raises(ValueError, match="no training rows"):
        gram.solve(np.zeros((4, 4)), "ridge", {})


def test_grid_on_all_features_matches_mllib(spark):
    """Every model of the linear grid, all features of the fixture, against one estimator fit for each fold."""
    train, _ = train_test(spark, "/root/testdata/sf0.001")
    spec = fixture_spec()
    spec = replace(spec, validation=replace(spec.validation, compare_n_splits=(3,), primary_n_splits=3))
    grid = [Experiment("ridge", (("alpha", 3.0),)), Experiment("lasso", (("alpha", 0.01), ("max_iter", 10000))),
            Experiment("elasticnet", (("alpha", 0.01), ("l1_ratio", 0.5), ("max_iter", 10000)))]
    cv = CrossValidation(spark, train, spec)
    _, oof, _ = cv.evaluate(grid)
    assert not cv.log.errors
    got = {(r.experiment, r[ID]): r.prediction for r in oof.collect()}
    for e in grid:
        for f in range(3):
            valid, _ = cv.fit_fold(e, 3, f)
            for r in valid.collect():
                assert got[e.name, r[ID]] == pytest.approx(r.prediction, abs=5e-4)
    assert len(got) == 3 * train.count() and TARGET not in oof.columns


def test_one_bad_experiment_fails_alone(spark):
    train, _ = train_test(spark, "/root/testdata/sf0.001")
    spec = fixture_spec()
    spec = replace(spec, validation=replace(spec.validation, compare_n_splits=(2,), primary_n_splits=2))
    cv = CrossValidation(spark, train.select(ID, TARGET, "area_living"), spec)
    results, oof, _ = cv.evaluate([Experiment("ridge", (("alpha", "odd"),)), Experiment("ridge", (("alpha", 1.0),))])
    assert [r.params for r in results] == [{"alpha": 1.0}] and {e[0] for e in cv.log.errors} == {Experiment("ridge", (("alpha", "odd"),)).name}
    assert oof.select("experiment").distinct().count() == 1
