"""Literal fixtures: exact quantiles, modes, clipping, unknown categories, correlations, scaling, ranks."""

import math

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plinth.operators.prep import ClipModel, fit_numeric_fill, fit_scaler, onehot_stages
from plinth.operators import quantile
from plinth.operators.quantile import quantile_dict
from plinth.operators.rank import global_rank, prefix_sums
from plinth.operators.categories import categories
from plinth.operators.correlate import pair_correlations
from plinth.operators.stats import modes


def test_median_is_interpolated(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (10.0,), (11.0,)], "a double")
    assert fit_numeric_fill(df, ["a"], "median")[None]["a"] == 7.0


def test_quantiles_match_pandas_grouped(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 500), "x": rng.normal(size=500).round(2)})
    pdf.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(pdf)
    got = quantile_dict(df, ["x"], [0.01, 0.25, 0.5, 0.99], ["g"])
    for (g, _, p), v in got.items():
        assert math.isclose(v, pdf[pdf.g == g].x.quantile(p), rel_tol=1e-12, abs_tol=1e-12)


def test_quantiles_with_a_hot_value(spark):
    # a third of the rows share one value: pre-aggregation makes it one row
    vals = [5.0] * 300 + [float(i) for i in range(600)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(8)
    got = quantile_dict(df, ["x"], [0.25, 0.5, 0.75])
    exp = pd.Series(vals).quantile([0.25, 0.5, 0.75]).tolist()
    assert [got[("x", p)] for p in (0.25, 0.5, 0.75)] == exp


def test_brackets_at_any_size(spark, monkeypatch):
    """Sketches, brackets that miss and the distributed selection give the same quantiles."""
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 4000), "x": rng.normal(size=4000), "y": rng.integers(0, 3, 4000).astype(float),
                        "z": np.where(rng.random(4000) < 0.5, 7.0, rng.random(4000)), "n": np.full(4000, np.nan)})
    pdf.loc[::7, "x"] = np.nan
    df, probs = spark.createDataFrame(pdf).repartition(6), [0.0, 0.01, 0.5, 0.75, 1.0]
    want = {(g, c, p): pdf[pdf.g == g][c].quantile(p) for g in (0, 1) for c in "xyz" for p in probs}
    monkeypatch.setattr(quantile, "KEEP_ALL", 10)
    kept = []
    inside = quantile._inside
    monkeypatch.setattr(quantile, "_inside", lambda *a: kept.append(inside(*a)) or kept[-1])
    for rows in (100_000, 0):
        monkeypatch.setattr(quantile, "DRIVER_ROWS", rows)
        got = quantile_dict(df, ["x", "y", "z", "n"], probs, ["g"])
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)
        assert kept[-1].filter("column = 'x' AND prob = 0.5 AND value IS NOT NULL").count() < 60      # of 3,400 values
    monkeypatch.setattr(quantile, "_bracket", lambda n, found, i: (50.0, 60.0))                       # no bracket holds its rank
    assert quantile_dict(df, ["x", "y", "z"], probs, ["g"]).keys() == want.keys()
    monkeypatch.undo()
    monkeypatch.setattr(quantile, "KEEP_ALL", 10)
    folds = quantile.fold_quantiles(df, ["x", "z"], [0.5], "g", [0, 1], [0, 1])
    assert all(math.isclose(folds[f][c][0.5], want[1 - f, c, 0.5], rel_tol=1e-12) for f in (0, 1) for c in "xz")
    n, v = 1000, np.sort(rng.normal(size=1000))
    grid = np.array([0.0, 0.25, 0.5, 0.75, 1.0])
    lo, hi = quantile._added([(n, v[(grid * 999).astype(int)]), (n, v[(grid * 999).astype(int)])], grid, 999, 1000)
    assert v[0] <= lo < v[499] < hi < v[-1]


def test_mode_ties_go_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "x string")
    assert modes(df, ["x"])[None]["x"] == "a"


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(1, None), (2, 5.0)], "id int, v double")
    out = ClipModel.of(bounds={"v": [0.0, 1.0]}).transform(df).orderBy("id").collect()
    assert out[0]["v"] is None and out[1]["v"] == 1.0


def test_unknown_category_is_all_zeros(spark):
    fit = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    cats = categories(fit, ["x"])[None]
    apply = spark.createDataFrame([(1, "a"), (2, "c"), (3, "zzz"), (4, None)], "id int, x string")
    stages, cols = onehot_stages(apply, cats)
    out = (PipelineModel(stages).transform(apply).select("id", vector_to_array(cols[0]).alias("v"))
           .orderBy("id").collect())
    assert [r["v"] for r in out] == [[1.0, 0.0, 0.0], [0.0, 0.0, 1.0], [0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]


def test_pairwise_complete_correlation_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, None, 1.0), (3.0, 5.0, 1.0), (4.0, 4.0, 1.0)],
                               "a double, b double, k double")
    corr = pair_correlations(df, ["a", "b", "k"])[None]
    assert math.isclose(corr[("a", "b")], 0.7857142857142857, rel_tol=1e-12)
    assert corr[("a", "k")] is None


def test_scaler_population_std_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "f1 double, f2 double")
    s = fit_scaler(df, ["f1", "f2"])[None]
    assert math.isclose(s["f1"][1], 1.247219128924647, rel_tol=1e-12)
    assert s["f2"] == [5.0, 1.0]


def test_global_rank_ties_eight_partitions(spark):
    df = spark.range(1000).select("id", ((F.col("id") * 7919) % 97).cast("double").alias("y")).repartition(8)
    got = global_rank(df, [F.col("y"), F.col("id")], "r").toPandas().sort_values(["y", "id"])
    assert got["r"].tolist() == list(range(1, 1001))


def test_global_rank_of_any_number_of_ranges(spark):
    """Same ranks for one range and many, read in other splits than written; rows with a hot key are dealt by the
    tie-breaker; later scans read the columns they need and nothing else."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 89).alias("y"),
                                  F.lit("x" * 50).alias("wide")).repartition(6)
    want = {r.id: i for i, r in enumerate(sorted(df.collect(), key=lambda r: (r.y, r.id)), 1)}
    for n in (1, 4, 37):
        ranked = global_rank(df, [F.col("y"), F.col("id")], "r", n)
        assert {r.id: r.r for r in ranked.collect()} == want
        assert ranked.columns == ["id", "y", "wide", "r"]
    plan = ranked.select("id", "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "wide" not in plan and "y#" not in plan, plan
    assert global_rank(df.limit(0), [F.col("y"), F.col("id")], "r").count() == 0


def test_prefix_sums_per_key(spark):
    df = spark.createDataFrame([(k, float(v), 1) for k in ("a", "b") for v in range(50)], "k string, v double, w int")
    out, totals = prefix_sums(df, ["k"], "v", "w", num_partitions=4)
    rows = out.toPandas()
    assert totals == {("a",): 50, ("b",): 50}
    assert (rows["cum"] == rows["v"] + 1).all()


def test_fold_quantiles_without_explosion(spark):
    from plinth.operators.quantile import fold_quantiles
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"fold": rng.integers(0, 5, 1000), "x": rng.integers(0, 50, 1000).astype(float),
                        "y": rng.normal(size=1000)})
    pdf.loc[::11, "y"] = np.nan
    got = fold_quantiles(spark.createDataFrame(pdf), ["x", "y"], [0.5, 0.01], "fold", list(range(5)), list(range(5)))
    for f in range(5):
        tr = pdf[pdf.fold != f]
        for col in ("x", "y"):
            for p in (0.5, 0.01):
                assert math.isclose(got[f][col][p], tr[col].quantile(p), rel_tol=1e-12, abs_tol=1e-12)


def test_distinct_counts_are_exact(spark):
    from plinth.operators.clean import constant_columns
    from plinth.operators.stats import distinct_counts
    df = spark.range(5000).select(F.col("id").cast("double").alias("big"), (F.col("id") % 3).alias("small"),
                                  F.when(F.col("id") % 2 == 0, F.lit("a")).alias("gap"))
    cols = ["big", "small", "gap"]
    assert distinct_counts(df, cols)[None] == {"big": 5000, "small": 3, "gap": 2}
    assert constant_columns(df, cols, 2)[None] == ["gap"]
    assert constant_columns(df, cols, 4999)[None] == ["small", "gap"]
    assert constant_columns(df, cols, 5000)[None] == cols


def test_rank_by_computed_keys(spark):
    key = F.lpad((F.col("id") * 7919 % 1009).cast("string"), 5, "0")
    df = spark.range(0, 500, 1, 3).select("id", (F.col("id") % 2).alias("y"))
    got = global_rank(df, [F.col("y"), "k", F.col("id")], "r", 4, {"k": key})
    assert got.columns == ["id", "y", "r"]
    rows = {r["id"]: r["r"] for r in got.collect()}
    want = sorted(range(500), key=lambda i: (i % 2, f"{i * 7919 % 1009:05d}", i))
    assert rows == {i: n + 1 for n, i in enumerate(want)}


def test_seeded_keys_are_not_in_the_sort(spark):
    from plinth.operators import rank, split
    plans = []
    written = rank.written_table
    rank.written_table = lambda df, name: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), written(df, name))[1]
    try:
        df = spark.range(0, 100, 1, 3).select("id", (F.col("id") % 2).cast("int").alias("stratum"))
        split.stratified_kfold(df, "id", 5, 42)
        split.kfold(df, "id", 5, 42)
        split.stratified_holdout(df, "id", 0.2, 42)
    finally:
        rank.written_table = written
    sorts = [line for p in plans for line in p.splitlines() if "Sort [" in line]
    assert len(sorts) == 3 and not any("md5" in line for line in sorts)
