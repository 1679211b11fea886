import random
from functools import reduce

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from plinth.operators import neighbours
from plinth.operators.neighbours import NeighbourIndex, nearest
from plinth.plans.models import FitContext, build_estimator


def brute(scored, train, k):
    """row -> (d2, id) of the k nearest, all pairs, ties by id."""
    out = {}
    for row, v in scored:
        found = sorted((reduce(lambda s, x: s + (x[0] - x[1]) * (x[0] - x[1]), zip(v, w), 0.0), i) for i, w, _ in train)
        out[row] = found[:k]
    return out


def points(rng, n, kind):
    if kind == "clustered":
        centres = [[rng.uniform(-50, 50) for _ in range(3)] for _ in range(6)]
        return [[c + rng.gauss(0, 0.5) for c in rng.choice(centres)] for _ in range(n)]
    if kind == "lattice":                                                  # many equal distances and equal points
        return [[float(rng.randint(0, 4)) for _ in range(3)] for _ in range(n)]
    hot = [1.0, 2.0, 3.0]
    return [hot if rng.random() < 0.6 else [rng.uniform(0, 9) for _ in range(3)] for _ in range(n)]


@pytest.mark.parametrize("kind", ["clustered", "lattice", "hot"])
def test_matches_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "PIVOTS", 7)
    monkeypatch.setattr(neighbours, "BLOCK", 16)                           # many rings, parts and salts
    rng = random.Random(kind)
    train = [(i, v, float(i % 7)) for i, v in enumerate(points(rng, 500, kind))]
    scored = [(i, v) for i, v in enumerate(points(rng, 120, kind) + [train[3][1], [1e6, 0.0, 0.0]])]
    t = spark.createDataFrame(train, "id long, vec array<double>, y double").repartition(5)
    s = spark.createDataFrame(scored, "row long, vec array<double>").repartition(3)
    got = {}
    for r in nearest(s, t, 6, "row", "id", "vec", "y").orderBy("row", "place").collect():
        assert r.y == float(r.id % 7)
        got.setdefault(r.row, []).append((r.d2, r.id))
    assert got == brute(scored, train, 6)


def test_second_pass_skips_far_rings(spark):
    rng = np.random.default_rng(1)
    train = [(i, [float(c * 1000 + rng.normal()), float(rng.normal())]) for i, c in enumerate(np.arange(20_000) % 50)]
    t = spark.createDataFrame([(i, v, 0.0) for i, v in train], "id long, vec array<double>, y double")
    index = NeighbourIndex(t, 3, "id", "vec", "y")
    d = index.rings.distances(np.array([v for _, v in train[:200]]))
    home, bound = index.rings.home(d)
    row, _ = index.rings.reached(d, bound, home)
    assert len(row) < 0.1 * 200 * len(index.rings.cell)


def test_plan_has_no_cross_join(spark):
    t = spark.range(50).selectExpr("id", "array(CAST(id AS DOUBLE)) AS vec", "1.0D AS y")
    plan = nearest(t.withColumnRenamed("id", "row"), t, 2, "row", "id", "vec", "y")._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_few_rows_repeats_and_empty_tables(spark):
    t = spark.createDataFrame([(5, [0.0], 1.0), (3, [0.0], 2.0), (9, [4.0], 8.0)], "id long, vec array<double>, y double")
    s = spark.createDataFrame([(0, [0.0]), (1, [0.0]), (2, [3.0])], "row long, vec array<double>")
    got = [(r.row, r.id) for r in nearest(s, t, 9, "row", "id", "vec", "y").orderBy("row", "place").collect()]
    assert got == [(0, 3), (0, 5), (0, 9), (1, 3), (1, 5), (1, 9), (2, 9), (2, 3), (2, 5)]
    assert nearest(s, t.limit(0), 2, "row", "id", "vec", "y").count() == 0
    assert nearest(s.limit(0), t, 2, "row", "id", "vec", "y").count() == 0


def test_regressor(spark):
    rows = [(1, Vectors.dense(0.0), 1.0), (2, Vectors.dense(1.0), 3.0), (3, Vectors.sparse(1, [0], [5.0]), 7.0), (4, Vectors.dense(0.0), 2.0)]
    train = spark.createDataFrame(rows, ["key", "features", "label"])
    ctx = FitContext(n_rows=4, target_std=1.0)
    test = spark.createDataFrame([(Vectors.dense(0.0), "a"), (Vectors.dense(2.0), "b"), (Vectors.dense(2.0), "b")], ["features", "name"])
    plain = build_estimator("knn", {"n_neighbors": 2}, ctx, id_col="key").fit(train).transform(test).collect()
    assert sorted((r.name, r.prediction) for r in plain) == [("a", 1.5), ("b", 2.0), ("b", 2.0)]
    far = build_estimator("knn", {"n_neighbors": 3, "weights": "distance"}, ctx, id_col="key").fit(train).transform(test)
    got = {r.name: r.prediction for r in far.collect()}
    assert got["a"] == 1.5 and got["b"] == pytest.approx((3 / 1 + 1 / 2 + 2 / 2) / (1 + 1 / 2 + 1 / 2))
    with pytest.raises(ValueError, match="weights"):
        build_estimator("knn", {"weights": "odd"}, ctx)
