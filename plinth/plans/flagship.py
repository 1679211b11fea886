"""The minimum end-to-end slice used as the driver's smoke entry."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from plinth.operators.ensemble import leaderboard
from plinth.plans.cv import CrossValidation, Experiment
from plinth.sources.fixture import train_test
from plinth.spec import ModelSpec, fixture_spec


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx -> derived features -> log1p target -> stratified 5-fold -> ridge(alpha=10) and lasso per fold
    -> fold RMSE -> leaderboard rows."""
    spec = fixture_spec()
    spec = replace(spec, models=(ModelSpec("ridge", True, ((("alpha", 10.0),),)),
                                 ModelSpec("lasso", True, ((("alpha", 0.001), ("max_iter", 10000)),))))
    train, test = train_test(spark, sf_dir)
    cv = CrossValidation(spark, train, spec, test)
    exps = [Experiment(m.name, tuple(g)) for m in spec.models for g in m.grids]
    results, _, _ = cv.evaluate(exps)
    return leaderboard(spark, results, list(spec.validation.compare_n_splits))
