"""A run scored by a user's metric, its direction, and the fold-scored stack against plain numpy."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.functions.metrics import MAPE, R2, RMSE, Metric
from plinth.operators import ensemble as ens
from plinth.plans.cv import ExperimentResult, fold_scores
from plinth.plans.evaluator import RegressionScoreEvaluator, register_metric
from plinth.spec import EnsembleSpec, fixture_spec


def members(spark, n=60, folds=3):
    rng = np.random.default_rng(5)
    y = rng.normal(10, 1, n)
    p = np.stack([y + rng.normal(0, s, n) for s in (0.3, 0.6)], 1)
    fold = np.arange(n) % folds
    oof = spark.createDataFrame([(i, m, int(fold[i]), float(p[i, j])) for i in range(n) for j, m in enumerate("ab")],
                                "id long, experiment string, fold int, prediction double")
    return y, p, fold, oof, spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "id long, label double")


def test_fold_scored_stack(spark):
    y, p, fold, oof, truth = members(spark)
    got = {r.id: r.prediction for r in ens.stack_out_of_fold(oof, truth, "id", ["a", "b"], "ridge", {"alpha": 2.0}).collect()}
    for f in range(3):
        t = fold != f
        x, mean = p[t] - p[t].mean(0), p[t].mean(0)
        w = np.linalg.solve(x.T @ x + 2.0 * np.eye(2), x.T @ (y[t] - y[t].mean()))
        for i in np.flatnonzero(~t):
            assert abs(got[i] - (y[t].mean() + (p[i] - mean) @ w)) < 1e-8
    # an estimator that has no closed form is fitted fold by fold
    tree = ens.stack_out_of_fold(oof, truth, "id", ["a", "b"], "decision_tree", {"max_depth": 2})
    assert tree.count() == 60 and tree.select("id").distinct().count() == 60
    # leak test: labels of a fold do not move that fold's own predictions
    moved = truth.withColumn("label", F.when(F.col("id") % 3 == 0, F.col("label") + 100).otherwise(F.col("label")))
    again = {r.id: r.prediction for r in ens.stack_out_of_fold(oof, moved, "id", ["a", "b"], "ridge", {"alpha": 2.0}).collect()}
    assert all(abs(again[i] - got[i]) < 1e-6 for i in range(0, 60, 3)) and abs(again[1] - got[1]) > 1
    # a row without one member's prediction has none; a holdout can't be scored so
    lost = ens.stack_out_of_fold(oof.filter("NOT (id = 4 AND experiment = 'a')"), truth, "id", ["a", "b"])
    assert lost.count() == 59
    with pytest.raises(ValueError, match="two folds"):
        ens.stack_out_of_fold(oof.filter("fold = 0"), truth, "id", ["a", "b"])


def test_user_metric_and_direction(spark):
    y, p, fold, oof, truth = members(spark)
    for metric, want in ((MAPE, lambda t, v: np.mean(np.abs(np.expm1(t) - np.expm1(v)) / np.expm1(t))),
                         (R2, lambda t, v: 1 - ((t - v) ** 2).sum() / ((t - t.mean()) ** 2).sum()),
                         (Metric("worst", lambda a, b: F.max(F.abs(a - b))), lambda t, v: np.abs(t - v).max())):
        got = {(r.experiment, r.fold): r.score for r in fold_scores(oof, truth, "id", metric, "log1p").collect()}
        for j, m in enumerate("ab"):
            for f in range(3):
                assert abs(got[m, f] - want(y[fold == f], p[fold == f, j])) < 1e-9
    results = [ExperimentResult(n, n, {}, s, {5: s}) for n, s in (("a", 0.2), ("b", 0.9), ("c", float("nan")), ("d", 0.9))]
    order = lambda m: [r.experiment_name for r in ens.leaderboard(spark, results, [5], m).collect()]
    assert order(RMSE) == ["a", "b", "d", "c"] and order(R2) == ["b", "d", "a", "c"]
    assert ens.best(ens.leaderboard(spark, results, [5], R2), R2).first().experiment_name == "b"
    assert ens.leaderboard(spark, results, [5], R2).columns[-1] == "r2_5_folds"
    assert ens.choose_stack_or_single(0.8, {"a": 0.7}, R2) == ("stacking", 0.8)
    assert ens.choose_stack_or_single(0.8, {"a": 0.7}) == ("a", 0.7)


def test_pandas_aggregate_as_metric(spark):
    import pandas as pd
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def median_error(a: pd.Series, b: pd.Series) -> float:
        return float((a - b).abs().median())

    y, p, fold, oof, truth = members(spark)
    got = {(r.experiment, r.fold): r.score for r in fold_scores(oof, truth, "id", Metric("median_error", median_error)).collect()}
    assert abs(got["a", 1] - np.median(np.abs(y - p[:, 0])[fold == 1])) < 1e-12


def test_zero_targets_and_registered_names(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "label double, prediction double")
    register_metric(Metric("mean_gap", lambda y, p: F.avg(y - p), larger_is_better=True))
    ev = RegressionScoreEvaluator(metricName="mean_gap")
    assert ev.isLargerBetter() and ev.evaluate(df) == 0.0
    assert df.agg(MAPE.of(F.col("label"), F.col("prediction"))).first()[0] == 0.5
    assert df.filter("label = 0").agg(R2.of(F.col("label"), F.col("prediction"))).first()[0] is None


def test_unknown_stack_score():
    with pytest.raises(ValueError, match="stack score"):
        replace(fixture_spec(), ensembles=EnsembleSpec(stack_score="x")).validate()
