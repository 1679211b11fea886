"""Saved stages: estimators, fitted stages that hold others, tables beside them, refits of a run."""

from dataclasses import replace

import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from conftest import SF
from plinth.operators import categories
from plinth.operators.clean import FeatureCleaner
from plinth.operators.estimators import Clipper, Imputer, OneHot, Scaler
from plinth.plans.models import NearestNeighboursRegressor, TargetTransformRegressor
from plinth.plans.run import predict, run
from plinth.sources.csv import scan_csv
from plinth.sources.fixture import ID, TARGET, train_test
from plinth.spec import EnsembleSpec, ModelSpec, fixture_spec

ROWS = [(i, float(i % 9) if i % 7 else None, 5.0, ("a", "b", None)[i % 3], float(i)) for i in range(60)]
SCHEMA = "id long, x double, same double, kind string, label double"


def same(a, b):
    pd.testing.assert_frame_equal(a.toPandas().map(str), b.toPandas().map(str))


def test_estimators_fit_save_and_load(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    steps = [FeatureCleaner.of(exclude=["id", "label"]), Clipper.of(lower=0.1, upper=0.9, columns=["x"]),
             Imputer.of(exclude=["id", "label"]), Scaler.of(exclude=["id", "label"]), OneHot.of(columns=["kind"])]
    Pipeline(stages=steps).save(str(tmp_path / "unfitted"))
    model = Pipeline.load(str(tmp_path / "unfitted")).fit(df)
    out = model.transform(df)
    assert "same" not in out.columns and out.filter("x IS NULL OR kind IS NULL").count() == 0
    mean, std, low, high = out.agg(F.avg("x"), F.stddev_pop("x"), F.min("x"), F.max("x")).first()
    assert abs(mean) < 1e-9 and abs(std - 1) < 1e-9 and low < 0 < high
    model.save(str(tmp_path / "fitted"))
    same(PipelineModel.load(str(tmp_path / "fitted")).transform(df), out)
    # a value that was not seen is all zeros; an empty table gives no rows
    new = spark.createDataFrame([(1, 2.0, 5.0, "zz", 0.0)], SCHEMA)
    assert model.transform(new).first()["kind__oh"].numNonzeros() == 0
    assert model.transform(df.limit(0)).count() == 0


def test_clip_quantiles_in_order(spark):
    with pytest.raises(ValueError, match="in order"):
        Clipper.of(lower=0.9, upper=0.1).fit(spark.createDataFrame(ROWS, SCHEMA))


def test_stages_that_hold_others(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).fillna(0.0, ["x"])
    for i, est in enumerate((TargetTransformRegressor(LinearRegression()), NearestNeighboursRegressor(3, "distance", id_col="id"))):
        pipe = Pipeline(stages=[VectorAssembler(inputCols=["x", "same"], outputCol="features"), est])
        pipe.save(str(tmp_path / f"unfitted{i}"))
        model = Pipeline.load(str(tmp_path / f"unfitted{i}")).fit(df)
        want = model.transform(df).select("id", F.round("prediction", 9)).orderBy("id")
        model.save(str(tmp_path / f"fitted{i}"))
        same(PipelineModel.load(str(tmp_path / f"fitted{i}")).transform(df).select("id", F.round("prediction", 9)).orderBy("id"), want)


def test_dictionary_table_is_saved_with_its_stage(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(categories, "SMALL", 5)
    df = spark.range(200).select("id", F.concat(F.lit("v"), F.col("id") % 40).alias("kind"))
    model = OneHot.of(columns=["kind"]).fit(df)
    want = model.transform(df).select("id", F.col("kind__oh").cast("string")).orderBy("id")
    model.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    index = again.stages[0]
    assert index.path is None and str(tmp_path) in index.slots.inputFiles()[0]      # not in the work folder
    same(again.transform(df).select("id", F.col("kind__oh").cast("string")).orderBy("id"), want)


def test_run_saves_every_refit(spark, tmp_path):
    train, test = train_test(spark, SF)
    cols = ["overall_qual", "area_living", "alley", "yr_sold", "mo_sold"]
    spec = replace(fixture_spec(), models=(ModelSpec("ridge", True, ((("alpha", 1.0),),)),
                                           ModelSpec("decision_tree", True, ((("max_depth", 3),),))),
                   ensembles=EnsembleSpec(stack_score="fold"))
    out = run(spark, train.select(ID, TARGET, *cols), test.select(ID, *cols), spec, str(tmp_path / "out"))
    names = [r.experiment_name for r in out.leaderboard.collect() if not r.experiment_name.startswith("ensemble")]
    for name in names:
        found = predict(f"{tmp_path}/out/models/{name}", test, ID, TARGET).withColumnRenamed(TARGET, "price")
        kept = spark.read.parquet(f"{tmp_path}/out/predictions_all/experiment={name}")
        both = found.join(kept, ID)
        assert both.count() == test.count()
        assert both.filter(F.abs(F.col("price") - F.greatest(F.expm1("prediction"), F.lit(0.0))) > 1e-6 * F.col("price")).count() == 0
    stack = out.stack_scores["ensemble_stacking_ridge"]
    row = out.leaderboard.filter("experiment_name = 'ensemble_stacking_ridge'").first()
    assert set(stack) == {"in_sample", "fold"} and row.primary_score == stack["fold"] and row.score_kind == "fold_rmse"
    # the files of the run, read back
    board = scan_csv(spark, f"{tmp_path}/out/results")
    assert sorted(r.experiment_name for r in board.collect()) == sorted(r.experiment_name for r in out.leaderboard.collect())
    missing = scan_csv(spark, f"{tmp_path}/out/eda/missing")
    counts = {x: train.filter(F.col(x).isNull()).count() for x in [ID, TARGET, *cols]}
    assert {r["column"]: int(r["missing_count"]) for r in missing.collect()} == {x: n for x, n in counts.items() if n}
