"""Engine: experiment names, grid, penalty mapping, CV on fx, leak test, save/load of stages."""

import math
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from conftest import SF
from plinth.functions.hashing import experiment_name
from plinth.operators.clean import FeatureCleanerModel
from plinth.operators.prep import ImputeModel, ScaleModel
from plinth.plans.cv import CrossValidation, iter_experiments
from plinth.plans.models import FitContext, linear_params
from plinth.sources.fixture import train_test
from plinth.spec import ModelSpec, fixture_spec, house_prices_spec


def test_experiment_name():
    assert experiment_name("ridge", {"alpha": 1.0}) == "ridge__63bf31cefb"


def test_default_grid_has_seven_experiments():
    assert [e.model_name for e in iter_experiments(house_prices_spec())] == \
        ["ridge", "ridge", "ridge", "lasso", "lasso", "elasticnet", "random_forest"]


def test_primary_split_must_be_compared():
    from plinth.spec import ValidationSpec
    with pytest.raises(ValueError):
        replace(house_prices_spec(), validation=ValidationSpec(compare_n_splits=(3,), primary_n_splits=5)).validate()


def test_penalty_mapping():
    ctx = FitContext(n_rows=100, target_std=2.0)
    assert math.isclose(linear_params("ridge", {"alpha": 10.0}, ctx)["regParam"], 10.0 * 2.0 / 100)
    en = linear_params("elasticnet", {"alpha": 0.1, "l1_ratio": 0.5}, ctx)
    assert math.isclose(en["regParam"], 0.05 + 0.05 * 2.0)
    assert math.isclose(en["elasticNetParam"], 0.05 / en["regParam"])


def test_solvers_agree(spark):
    from pyspark.ml.feature import VectorAssembler
    from plinth.plans.models import build_estimator
    rows = [(float(i % 7), float((i * i) % 11), 1.5 * (i % 7) - 0.2 * ((i * i) % 11) + (i % 3)) for i in range(60)]
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "a double, b double, label double"))
    std = df.selectExpr("stddev_pop(label)").first()[0]
    for name, params in (("ridge", {"alpha": 5.0}), ("lasso", {"alpha": 0.3}), ("elasticnet", {"alpha": 0.4, "l1_ratio": 0.3})):
        found = [build_estimator(name, {**params, "solver": s}, FitContext(60, std, 2)).fit(df) for s in ("normal", "l-bfgs")]
        assert all(math.isclose(x, y, rel_tol=1e-5, abs_tol=1e-7) for x, y in zip(*[[*m.coefficients, m.intercept] for m in found]))


def test_ids_must_be_unique(spark):
    from plinth.plans.cv import check_key
    check_key(spark.range(5), "id")
    for rows in ([(1,), (1,)], [(None,), (2,)]):
        with pytest.raises(ValueError, match="must be unique"):
            check_key(spark.createDataFrame(rows, "id long"), "id")


def _toy(spark, id_type: str):
    rows = [(i, float(i % 5), None if i % 4 == 0 else "ab"[i % 2], 10.0 + 3 * (i % 5) + (i % 4 == 0)) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v double, s string, y double")
    return df.withColumn("id", F.concat(F.lit("k"), F.col("id")) if id_type == "string" else F.col("id"))


def _toy_spec(**data):
    base = fixture_spec()
    return replace(base, data=replace(base.data, target_col="y", id_col="id", **data),
                   features=replace(base.features, enabled=False), models=(ModelSpec("ridge", True, ((("alpha", 1.0),),)),))


@pytest.mark.parametrize("id_type,as_feature", [("string", False), ("long", True)])
def test_row_key_keeps_type_and_values(spark, id_type, as_feature):
    df = _toy(spark, id_type)
    spec = _toy_spec(id_as_feature=as_feature)
    cv = CrossValidation(spark, df, spec, df.drop("y"))
    assert ("id" in cv.features) == as_feature
    _, oof, _ = cv.evaluate(iter_experiments(spec))
    _, preds = cv.fit_full(iter_experiments(spec)[0])
    want = sorted(r[0] for r in df.select("id").collect())
    for found in (oof, preds):
        assert dict(found.dtypes)["id"] == {"long": "bigint"}.get(id_type, id_type)
        assert sorted(r["id"] for r in found.select("id").collect()) == want


def test_native_categories_are_chosen_by_model(spark):
    """One run holds a one-hot and a native-category model; the latter's gaps are a category."""
    df = _toy(spark, "long")
    spec = replace(_toy_spec(), models=(ModelSpec("ridge", True, ((("alpha", 1.0),),)),
                                        ModelSpec("catboost", True, ((("depth", 1), ("iterations", 1)),))))
    cv = CrossValidation(spark, df, spec)
    results, oof, _ = cv.evaluate(iter_experiments(spec))
    assert len(results) == 2 and oof.count() == 80 and not cv.log.errors
    native, onehot = cv.recipes(5, False, False)[0], cv.recipes(5, False, True)[0]
    assert native.cats["s"] == ["Missing", "a", "b"] and native.cat_fill["s"] == "Missing" and not native.encode
    assert onehot.cats["s"] == ["a", "b"] and onehot.encode
    assert cv.recipes(None, False, False)[None].cats["s"] == ["Missing", "a", "b"]


def test_base_scan_is_pruned_and_filtered(spark):
    cv = CrossValidation(spark, _toy(spark, "long"), _toy_spec())
    plan = cv.base.select("id", "v").filter("v > 2")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(v), GreaterThan(v,2.0)]" in plan and "ReadSchema: struct<id:bigint,v:double>" in plan


def test_tree_parameters():
    from plinth.plans.models import build_estimator, dropped_params
    ctx = FitContext(10, 1.0)
    assert build_estimator("lightgbm", {"num_leaves": 31}, ctx).getMaxDepth() == 5
    assert build_estimator("xgboost", {}, ctx).getMaxDepth() == 6
    assert build_estimator("random_forest", {"random_state": 0, "bootstrap": False}, ctx).getSeed() == 0
    assert dropped_params("random_forest", {"min_samples_split": 3, "max_depth": 2}) == ["min_samples_split"]
    with pytest.raises(ValueError):
        build_estimator("decision_tree", {"max_depth": 31}, ctx)


@pytest.fixture(scope="module")
def cv_run(spark):
    train, test = train_test(spark, SF)
    spec = replace(fixture_spec(), models=(ModelSpec("ridge", True, ((("alpha", 10.0),),)),
                                           ModelSpec("nope", True, ((),))))
    cv = CrossValidation(spark, train, spec, test)
    results, oof, _ = cv.evaluate(iter_experiments(spec))
    return cv, results, oof, train


def test_cv_covers_train_and_isolates_failures(cv_run):
    cv, results, oof, train = cv_run
    assert [r.model_name for r in results] == ["ridge"]
    assert any(e[0].startswith("nope") for e in cv.log.errors)
    assert oof.count() == train.count()
    assert oof.join(train, "id", "left_anti").count() == 0
    assert 0 < results[0].primary_score < 2


def test_cleaner_finds_planted_columns(cv_run):
    cv, _, _, _ = cv_run
    state = cv.recipes(None, True)[None]
    assert {"utilities", "area_living_copy"} <= set(state.drop)


def test_fold_statistics_ignore_validation_rows(spark, cv_run):
    """Changing a validation row of fold 0 must not change fold 0's fitted statistics."""
    cv, _, _, _ = cv_run
    from plinth.plans.recipe import fit_recipe
    from plinth.operators.split import training_rows, FOLD
    base = cv.base.withColumnRenamed("fold_5", FOLD)
    victim = base.filter(F.col(FOLD) == 0).select("id").first()["id"]
    poisoned = base.withColumn("area_living", F.when(F.col("id") == victim, F.lit(1e9)).otherwise(F.col("area_living")))
    a = fit_recipe(training_rows(base, 5), cv.features, cv.spec.prep, True, "train_fold", list(range(5)))[0]
    b = fit_recipe(training_rows(poisoned, 5), cv.features, cv.spec.prep, True, "train_fold", list(range(5)))[0]
    assert a.num_fill == b.num_fill and a.scale == b.scale and a.drop == b.drop


def test_stage_save_load(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "x"), (2, 3.0, None)], "id int, v double, s string")
    model = PipelineModel([FeatureCleanerModel.of(drop=["id"]),
                           ImputeModel.of(numeric={"v": 2.0}, categorical={"s": "Missing"}),
                           ScaleModel.of(scale={"v": [1.0, 2.0]})])
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert again.transform(df).collect() == model.transform(df).collect()


def test_exploratory_filter():
    from plinth.plans.grid import exploratory_models
    active, skipped = exploratory_models(house_prices_spec())
    assert [e.model_name for e in active] == ["ridge", "lasso", "elasticnet", "random_forest"]
    assert dict(active[0].params) == {"alpha": 1.0}
    assert ("dnn", "disabled") in skipped and len(skipped) == 4


def test_scaling_rules():
    from plinth.plans.models import needs_scaling
    assert needs_scaling("ridge") and needs_scaling("knn") and needs_scaling("dnn")
    assert not needs_scaling("random_forest") and not needs_scaling("ridge", scale_linear=False)


def test_unknown_model_is_an_error():
    from plinth.plans.models import build_estimator
    with pytest.raises(ValueError):
        build_estimator("svm", {}, FitContext(10, 1.0))


def test_evaluator_lower_is_better(spark):
    from plinth.plans.evaluator import RegressionScoreEvaluator
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0)], "label double, prediction double")
    ev = RegressionScoreEvaluator(metricName="rmse")
    assert not ev.isLargerBetter() and math.isclose(ev.evaluate(df), math.sqrt(0.5))


def test_fold_complement_equals_exploded(spark, cv_run):
    """Per-fold statistics from per-fold aggregates equal those from exploded training rows."""
    cv, _, _, _ = cv_run
    from plinth.operators.split import FOLD, training_rows
    from plinth.plans.recipe import add_scaler, add_scaler_folds, fit_recipe, fit_recipe_folds
    base = cv.base
    folds = list(range(5))
    fast = fit_recipe_folds(base, cv.features, cv.spec.prep, "fold_5", folds)
    stacked = training_rows(base.withColumnRenamed("fold_5", FOLD), 5)
    slow = fit_recipe(stacked, cv.features, cv.spec.prep, False, "train_fold", folds)
    fast_s = add_scaler_folds(base, fast, "fold_5")
    slow_s = add_scaler(stacked, slow, "train_fold")
    for f in folds:
        a, b = fast_s[f], slow_s[f]
        assert a.drop == b.drop and a.numeric == b.numeric and a.categorical == b.categorical
        assert a.num_fill == b.num_fill and a.cat_fill == b.cat_fill and a.cats == b.cats
        for x, (mu, sd) in b.scale.items():
            assert math.isclose(a.scale[x][0], mu, rel_tol=1e-9, abs_tol=1e-9)
            assert math.isclose(a.scale[x][1], sd, rel_tol=1e-9)


@pytest.mark.parametrize("prep_kw", [dict(clip_outliers=True), dict(numeric_imputer_strategy="mean"),
                                     dict(exact_quantiles=False), dict(categorical_imputer_strategy="constant")])
def test_cv_other_recipe_paths(spark, prep_kw):
    """Clipping, mean imputation, approximate quantiles and constant fill all run end to end."""
    train, test = train_test(spark, SF)
    base = fixture_spec()
    spec = replace(base, prep=replace(base.prep, **prep_kw),
                   models=(ModelSpec("ridge", True, ((("alpha", 10.0),),)),))
    cv = CrossValidation(spark, train, spec, test)
    results, oof, _ = cv.evaluate(iter_experiments(spec))
    assert not cv.log.errors and len(results) == 1 and 0 < results[0].primary_score < 2
    assert oof.count() == train.count()
    _, preds = cv.fit_full(iter_experiments(spec)[0])
    assert preds.count() == test.count()
    if prep_kw.get("clip_outliers"):
        assert cv.recipes(5, True)[0].clip


def test_holdout_cv(spark):
    from plinth.spec import ValidationSpec
    train, test = train_test(spark, SF)
    spec = replace(fixture_spec(), validation=ValidationSpec(compare_n_splits=(1,), primary_n_splits=1),
                   models=(ModelSpec("ridge", True, ((("alpha", 1.0),),)),))
    cv = CrossValidation(spark, train, spec, test)
    results, oof, _ = cv.evaluate(iter_experiments(spec))
    n = train.count()
    assert len(results) == 1 and oof.count() == math.ceil(0.2 * n)
