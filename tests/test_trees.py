import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import GBTRegressor

from plinth.operators import forest
from plinth.operators.trees import BoostedTreesRegressor, Columns, fit_columns, nodes_of, raw_rows
from plinth.plans.cv import CrossValidation, Experiment
from plinth.plans.models import FitContext, build_estimator
from plinth.sources.fixture import ID, TARGET, train_test
from plinth.spec import fixture_spec

from conftest import SF


def _rows(spark, n=800):
    rng = np.random.default_rng(3)
    a, b, g = rng.integers(0, 25, n), rng.integers(0, 20, n), rng.integers(0, 4, n)
    y = np.sin(a / 4) * 3 + b * 0.1 + (g == 2) * 2 + rng.normal(0, 0.1, n)
    return spark.createDataFrame([(i, Vectors.dense(float(a[i]), float(b[i]), *(float(g[i] == k) for k in range(3)), 7.0), float(y[i]))
                                  for i in range(n)], ["id", "features", "label"])


def _predictions(model, df):
    return np.array([r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()])


def test_boosting_is_that_of_mllib(spark):
    df = _rows(spark)
    found = BoostedTreesRegressor(trees=4, step=0.3, depth=3, id_col="id").fit(df)
    expected = GBTRegressor(maxIter=4, stepSize=0.3, maxDepth=3, maxBins=64).fit(df)
    assert np.allclose(_predictions(found, df), _predictions(expected, df), atol=1e-9)


def test_rows_of_a_tree_do_not_depend_on_the_partitions(spark):
    df = _rows(spark)
    params = {"n_estimators": 3, "learning_rate": 0.3, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.7}
    found = [_predictions(build_estimator("xgboost", params, FitContext(800, 1.0), id_col="id").fit(df.repartition(n)), df) for n in (2, 5)]
    assert np.allclose(*found, atol=1e-9)


def test_columns_of_all_rows(spark):
    columns, rows, slots = fit_columns(raw_rows(_rows(spark), "features", "label", "id"), 256)
    assert (rows, slots) == (800, 6)
    assert columns.slots == [[0], [1], [2, 3, 4]]              # one-hot slots share a column, the constant has none
    assert list(columns.cuts[1]) == [i + 0.5 for i in range(19)]
    assert columns.codes(np.array([[3.0, 19.0, 0, 1, 0, 7], [0, 0, 0, 0, 0, 7]])).tolist() == [[3, 0], [19, 0], [2, 0]]


def test_a_boosted_refit_keeps_no_vectors(spark):
    train, test = train_test(spark, SF)
    cv = CrossValidation(spark, train.select(ID, TARGET, "overall_qual", "alley"), fixture_spec(), test, folds=False)
    _, preds = cv.fit_full(Experiment("xgboost", (("max_depth", 2), ("n_estimators", 2))))
    assert not cv._prepared and preds.count() == test.count()


# ------------------------------------------------------------------ forests


def _split(x, y, w):
    """The best split by trying all."""
    best = None
    for j in range(x.shape[1]):
        for v in np.unique(x[:, j])[:-1]:
            low = x[:, j] <= v
            gain = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (low, ~low))
            if best is None or gain > best[0] + 1e-9:
                best = (gain, j, v)
    return best


def _fitted(x, y, w):
    best = None if len(y) == 1 or y.min() == y.max() else _split(x, y, w)
    if best is None:
        return np.full(len(y), np.average(y, weights=w))
    low, out = x[:, best[1]] <= best[2], np.empty(len(y))
    out[low], out[~low] = _fitted(x[low], y[low], w[low]), _fitted(x[~low], y[~low], w[~low])
    return out


def test_growth_is_that_of_trying_all_splits():
    rng = np.random.default_rng(1)
    columns = Columns([np.arange(30) + 0.5, np.arange(200) + 0.5, None], [[0], [1], [2, 3, 4]], [])
    for n in (1, 2, 30, 90):
        g = rng.integers(0, 4, n)
        x = np.c_[rng.integers(0, 30, n), rng.integers(0, 200, n), g[:, None] == np.arange(3)].astype(float)
        y, w, codes = rng.normal(50, 3, n), rng.integers(1, 4, n).astype(float), columns.codes(x)
        tree = forest.grow(codes, y, w, columns)
        assert np.allclose(tree[3][nodes_of(tree, columns.grouped, codes)], _fitted(x, y, w), atol=1e-9)


def _unlimited(trees, **more):
    return build_estimator("random_forest", {"n_estimators": trees, "max_depth": None, "min_samples_leaf": 1, **more},
                           FitContext(800, 1.0), id_col="id")


def test_trees_grow_until_their_leaves_are_pure(spark):
    """Each row is three times the one before: one by one they are split off, beyond 30 levels."""
    y = 3.0 ** np.arange(40)
    df = spark.createDataFrame([(i, Vectors.dense(float(i)), float(y[i])) for i in range(40)], ["id", "features", "label"])
    assert np.allclose(_predictions(_unlimited(1, bootstrap=False).fit(df), df)[9:], y[9:])


def test_large_tables_are_grown_in_parts(spark, monkeypatch, tmp_path):
    df, few = _rows(spark), {"bootstrap": True, "random_state": 7}
    whole = _predictions(_unlimited(6, **few).fit(df), df)
    exact = _predictions(_unlimited(2, bootstrap=False).fit(df), df)
    monkeypatch.setattr(forest, "LOCAL_CELLS", 3 * 90)        # 90 rows a task
    monkeypatch.setattr(forest, "DEALT_BYTES", 40_000)
    model = _unlimited(6, **few).fit(df)
    assert model.nodes.groupBy("tree").count().agg({"count": "min"}).first()[0] > 4
    parts = _predictions(model, df)
    assert np.allclose(parts, whole, atol=1e-9)
    assert np.allclose(_predictions(_unlimited(2, bootstrap=False).fit(df), df), exact, atol=1e-9)
    model.write().save(f"{tmp_path}/m")
    assert np.allclose(_predictions(forest.ForestModel.load(f"{tmp_path}/m"), df), parts)


def test_a_large_node_that_cannot_be_split_is_a_leaf(spark, monkeypatch):
    monkeypatch.setattr(forest, "LOCAL_CELLS", 10)
    rows = [(i, Vectors.dense(float(i % 2)), 5.0 if i % 2 else float(i % 3)) for i in range(120)]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    assert np.allclose(_predictions(_unlimited(1, bootstrap=False).fit(df), df), [5.0 if i % 2 else 1.0 for i in range(120)])


def test_the_forest_query_asks_for_the_forest_of_the_default_grid(monkeypatch):
    from plinth.plans import catalog_models
    from plinth.spec import DEFAULT_MODELS
    asked = {}
    monkeypatch.setattr(catalog_models, "_full_recipe", lambda spark, sf, model, params: asked.update({model: params}))
    catalog_models.model_forest(None, SF)
    grid = dict(next(m for m in DEFAULT_MODELS if m.name == "random_forest").grids[0])
    assert asked == {"random_forest": {k: v for k, v in grid.items() if k != "n_jobs"}}
