import random
from dataclasses import replace

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plinth.operators import categories as cat
from plinth.operators.prep import dummies, onehot_stages
from plinth.plans.cv import CrossValidation, Experiment
from plinth.plans.recipe import fit_recipe_folds
from plinth.spec import DataSpec, PrepSpec, Spec, ValidationSpec


def rows(spark, n=300, values=40, more="Z"):
    rng = random.Random(5)
    names = ["", "ä", more, "z", "0", "a b", *(f"v{i}" for i in range(values))]
    made = [(i, rng.choice(names) if rng.random() < 0.9 else None, rng.choice("xy"), float(rng.random()), i % 3) for i in range(n)]
    return spark.createDataFrame(made, "id long, big string, small string, num double, fold int")


def test_tables_and_lists_have_the_same_slots(spark, monkeypatch):
    df = rows(spark)
    listed = cat.categories(df, ["big", "small"])[None]
    apply = spark.createDataFrame([(i, v) for i, v in enumerate([*listed["big"], None, "unseen"])], "id long, big string")
    def encoded(values):
        stages, cols = onehot_stages(apply, {"big": values})
        out = PipelineModel(stages).transform(apply).select("id", vector_to_array(cols[0]).alias("v"))
        return {r.id: r.v for r in out.collect()}
    want = encoded(listed["big"])
    monkeypatch.setattr(cat, "SMALL", 10)
    tabled = cat.categories(df, ["big", "small"])[None]
    assert isinstance(tabled["big"], cat.CategoryTable) and tabled["small"] == listed["small"] == ["x", "y"]
    assert encoded(tabled["big"]) == want and sum(want[len(want) - 1]) == sum(want[len(want) - 2]) == 0


@pytest.mark.parametrize("strategy", ["most_frequent", "constant"])
def test_folds_agree_at_any_limit(spark, monkeypatch, strategy):
    df = rows(spark)
    prep = PrepSpec(categorical_imputer_strategy=strategy, drop_correlated_features=False)
    few = fit_recipe_folds(df, ["big", "small", "num"], prep, "fold", [0, 1, 2])
    monkeypatch.setattr(cat, "SMALL", 10)
    many = fit_recipe_folds(df, ["big", "small", "num"], prep, "fold", [0, 1, 2])
    for f in (0, 1, 2):
        assert many[f].cat_fill == few[f].cat_fill and len(many[f].cats["big"]) == len(few[f].cats["big"])
        table = spark.read.parquet(many[f].cats["big"].path).orderBy("slot").collect()
        assert [(r.value, r.slot) for r in table] == [(v, i) for i, v in enumerate(few[f].cats["big"])]
        seen = {r.big for r in df.filter(F.col("fold") != f).collect()} - {None}
        assert set(few[f].cats["big"]) == seen | ({few[f].cat_fill["big"]})


def test_dummies_of_a_large_column_are_one_vector(spark, monkeypatch):
    df = rows(spark, more="q")
    wide, names = dummies(df, ["big", "small"])
    want = {r.id: [r[n] for n in names if n.startswith("big_")] for r in wide.collect()}
    monkeypatch.setattr(cat, "SMALL", 10)
    wide, names = dummies(df, ["big", "small"])
    assert names == ["small_x", "small_y", "big__oh"]
    assert {r.id: r.big__oh.toArray().tolist() for r in wide.collect()} == want
    assert dummies(rows(spark), ["big"])[1] == ["big__oh"]                  # "Z" and "z" can't both name a column


def spec_of(**prep):
    return replace(Spec(), data=DataSpec(target_col="y", id_col="id"), prep=PrepSpec(**prep),
                   validation=ValidationSpec(compare_n_splits=(2,), primary_n_splits=2))


@pytest.mark.parametrize("n", [20_000, 200_000])
def test_many_categories_through_cross_validation_and_refit(spark, n):
    df = spark.range(2 * n).selectExpr("id", f"concat('c', id % {n}) AS name", "CAST(id % 7 AS DOUBLE) AS x",
                                       "CAST(1 + id % 5 AS DOUBLE) AS y")
    spec = spec_of(drop_correlated_features=False)
    cv = CrossValidation(spark, df, spec, df.filter("id < 50").drop("y"))
    exp = Experiment("ridge", (("alpha", 1.0), ("max_iter", 3)))
    if n < 100_000:
        results, oof, _ = cv.evaluate([exp])
        assert not cv.log.errors and oof.count() == 2 * n and results[0].primary_score < 1
    model, preds = cv.fit_full(exp)
    assert preds.count() == 50 and model.stages[-1].numFeatures == n + 1
