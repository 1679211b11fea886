"""Registered queries for models, cross-validation, ensembles and outputs.

Oracles are closed forms in SQL: one-feature (or two-feature) least squares,
ridge, lasso and elastic net solutions per fold, computed from covariances
of each fold's training rows.  The Spark side runs the real engine (recipe,
MLlib fits, out-of-fold tables, blends, stack) on the same rows.
Trees, forests, boosting and the recipes are checked in small closed forms
(depth 1, two columns); on all features they are rows-only checks.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.exprs import c
from plinth.functions.hashing import experiment_name
from plinth.functions.metrics import RMSE, rmse, rmsle
from plinth.functions.target import transform_target
from plinth.operators import ensemble as ens
from plinth.plans.catalog_data import SPEC, folds_sql, kfold_sql, r6, sql
from plinth.plans.cv import CrossValidation, Experiment, ExperimentResult
from plinth.plans.models import FitContext, TargetTransformRegressor, build_estimator
from plinth.plans.notebook import evaluate_model, fold_mean_stack
from plinth.plans.recipe import FEATURES, fit_recipe, recipe_stages
from plinth.session import work_path, written_table
from plinth.sources.fixture import ID, TARGET, fixture, split_rows, test_truth, train_test
from plinth.spec import FeatureSpec, ValidationSpec

Q: dict = {}
O: dict = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        Q[key] = fn
        if oracle is not None:
            O[key] = oracle
        return fn
    return deco


def _tt(spark, sf):
    return train_test(spark, sf)


def _written_tt(spark, sf, *cols):
    """(train, test) from one scan of the sources, written; all columns unless some are named."""
    fx = fixture(spark, sf)
    return split_rows(written_table(fx.select(ID, TARGET, *cols) if cols else fx, "fx"))


def _log_y(df: DataFrame) -> DataFrame:
    return df.withColumn("y", transform_target(c(TARGET), "log1p"))


def _fit_linear(df: DataFrame, xs: list[str], model: str, params: dict, label: str = "y"):
    st = df.agg(F.count(F.lit(1)), F.stddev_pop(label)).first()
    est = build_estimator(model, params, FitContext(n_rows=st[0], target_std=st[1], n_features=len(xs)),
                          label_col=label)
    return Pipeline(stages=[VectorAssembler(inputCols=xs, outputCol=FEATURES), est]).fit(df).stages[-1]


def _terms(spark, model, xs: list[str], digits: int = 9) -> DataFrame:
    rows = [("intercept", float(model.intercept))] + [(f"coef_{x}", float(v)) for x, v in zip(xs, model.coefficients)]
    return r6(spark.createDataFrame(rows, "term string, value double"), digits)

# ------------------------------------------------------------------ L: linear models (closed forms)


_Y = "ln(1 + sale_price)"


@register("model_ols", sql(f"""
SELECT unnest([{{'term': 'intercept', 'value': round(regr_intercept({_Y}, overall_qual::DOUBLE), 9)}},
               {{'term': 'coef_overall_qual', 'value': round(regr_slope({_Y}, overall_qual::DOUBLE), 9)}}],
              recursive := true) FROM train"""))
def model_ols(spark, sf):
    train, _ = _tt(spark, sf)
    return _terms(spark, _fit_linear(_log_y(train), ["overall_qual"], "linear_regression", {}), ["overall_qual"])


@register("model_ridge", sql(f"""
, s AS (SELECT count(*) AS n, avg({_Y}) AS my, avg(overall_qual::DOUBLE) AS m1, avg(area_living) AS m2,
               var_pop(overall_qual::DOUBLE) AS v1, var_pop(area_living) AS v2,
               covar_pop(overall_qual::DOUBLE, area_living) AS c12,
               covar_pop(overall_qual::DOUBLE, {_Y}) AS c1y, covar_pop(area_living, {_Y}) AS c2y FROM train),
w AS (SELECT n, my, m1, m2, n * v1 + 10.0 AS a, n * c12 AS b, n * v2 + 10.0 AS d, n * c1y AS s1, n * c2y AS s2 FROM s),
sol AS (SELECT my, m1, m2, (d * s1 - b * s2) / (a * d - b * b) AS w1, (a * s2 - b * s1) / (a * d - b * b) AS w2 FROM w)
SELECT unnest([{{'term': 'intercept', 'value': round(my - w1 * m1 - w2 * m2, 9)}},
               {{'term': 'coef_overall_qual', 'value': round(w1, 9)}},
               {{'term': 'coef_area_living', 'value': round(w2, 9)}}], recursive := true) FROM sol"""))
def model_ridge(spark, sf):
    """Ridge(alpha=10) on two raw features: exact penalty mapping onto the normal-equation solver."""
    train, _ = _tt(spark, sf)
    xs = ["overall_qual", "area_living"]
    return _terms(spark, _fit_linear(_log_y(train), xs, "ridge", {"alpha": 10.0}), xs)


def _shrink_sql(alpha: float, l1_ratio: float) -> str:
    return f"""
, s AS (SELECT avg({_Y}) AS my, avg(area_living) AS mx, var_pop(area_living) AS v,
               covar_pop(area_living, {_Y}) AS cxy FROM train),
sol AS (SELECT my, mx, sign(cxy) * greatest(abs(cxy) - {alpha * l1_ratio}, 0) / (v + {alpha * (1 - l1_ratio)}) AS w
        FROM s)
SELECT unnest([{{'term': 'intercept', 'value': round(my - w * mx, 9)}},
               {{'term': 'coef_area_living', 'value': round(w, 9)}}], recursive := true) FROM sol"""


@register("model_lasso", sql(_shrink_sql(1.0, 1.0)))
def model_lasso(spark, sf):
    """Lasso(alpha=1) on one raw feature: the soft-threshold solution."""
    train, _ = _tt(spark, sf)
    return _terms(spark, _fit_linear(_log_y(train), ["area_living"], "lasso", {"alpha": 1.0, "max_iter": 10000}),
                  ["area_living"])


@register("model_elasticnet", sql(_shrink_sql(1.0, 0.5)))
def model_elasticnet(spark, sf):
    train, _ = _tt(spark, sf)
    return _terms(spark, _fit_linear(_log_y(train), ["area_living"], "elasticnet",
                                     {"alpha": 1.0, "l1_ratio": 0.5, "max_iter": 10000}), ["area_living"])


_KNN_D = " + ".join(f"(s.{x} - t.{x}) * (s.{x} - t.{x})" for x in ("area_living", "overall_qual", "garage", "mo_sold"))
_KNN_SQL = sql(f"""
, t AS (SELECT id, {_Y} AS y, area_living, overall_qual, coalesce(area_garage, 0) AS garage, mo_sold FROM train),
s AS (SELECT id, area_living, overall_qual, coalesce(area_garage, 0) AS garage, mo_sold FROM test),
n AS (SELECT s.id, min_by(t.y, CAST({_KNN_D} AS BIGINT) * 1000000000000 + t.id, 5) AS ys FROM s, t GROUP BY s.id)
SELECT id, round(list_avg(ys), 6) AS prediction FROM n""")


@register("model_knn", _KNN_SQL)
def model_knn(spark, sf):
    """Mean log target of the 5 nearest training rows of every test row (raw features, ties by id)."""
    xs = ["area_living", "overall_qual", "area_garage", "mo_sold"]
    train, test = _written_tt(spark, sf, *xs)
    vector = VectorAssembler(inputCols=xs, outputCol=FEATURES)
    rows = [vector.transform(df.fillna(0.0, subset=["area_garage"])) for df in (_log_y(train), test)]
    est = build_estimator("knn", {"n_neighbors": 5}, FitContext(n_rows=0, target_std=0.0), label_col="y", id_col=ID)
    return r6(est.fit(rows[0]).transform(rows[1]).select(ID, "prediction"))


def _lbfgs(model: str, xs: list[str], params: dict):
    """The same closed form through the solver of wide inputs."""
    def run(spark, sf):
        train, _ = _tt(spark, sf)
        return _terms(spark, _fit_linear(_log_y(train), xs, model, {**params, "solver": "l-bfgs", "max_iter": 10000}), xs, 6)
    return run


def _rounded(text: str) -> str:
    return text.replace(", 9)", ", 6)")


register("model_ridge_lbfgs", _rounded(O["model_ridge"]))(_lbfgs("ridge", ["overall_qual", "area_living"], {"alpha": 10.0}))
register("model_lasso_lbfgs", _rounded(O["model_lasso"]))(_lbfgs("lasso", ["area_living"], {"alpha": 1.0}))
register("model_elasticnet_lbfgs", _rounded(O["model_elasticnet"]))(
    _lbfgs("elasticnet", ["area_living"], {"alpha": 1.0, "l1_ratio": 0.5}))

# ------------------------------------------------------------------ engine runs with closed-form members


# Three one-feature members run through the whole engine (cleaner, imputer,
# scaler, MLlib) with shared stratified folds.
MEMBERS = [("ridge", "overall_qual", (("alpha", 10.0),)),
           ("lasso", "area_living", (("alpha", 0.001), ("max_iter", 10000))),
           ("elasticnet", "year_built", (("alpha", 0.001), ("l1_ratio", 0.5), ("max_iter", 10000)))]
_NO_FE = FeatureSpec(enabled=False)


def _member_name(model: str, params: tuple) -> str:
    return experiment_name(model, dict(params))


def _name_sql(model: str, params: tuple) -> str:
    return f"'{model}__' || substr(md5('{json.dumps(dict(params), sort_keys=True)}'), 1, 10)"


def _spec(splits=(5,), primary=5, metric=RMSE):
    from dataclasses import replace
    return replace(SPEC, features=_NO_FE, validation=ValidationSpec(compare_n_splits=tuple(splits),
                                                                     primary_n_splits=primary, metric=metric))


def run_members(spark, sf, members=MEMBERS, splits=(5,), primary=5, refit=False, metric=RMSE):
    """Per member: CV (OOF long table) and, with ``refit``, a full fit (test predictions, else None);
    folds shared by the members."""
    from dataclasses import replace
    spec = _spec(splits, primary, metric)
    # the members submit as many fold fits at once as one engine would, which bounds what the driver plans at a time
    spec = replace(spec, parallelism=max(1, spec.parallelism // len(members)))
    # one scan of the sources, one table of rows and folds for all members
    train, test = _written_tt(spark, sf, *dict.fromkeys(x for _, x, _ in members))
    shared = CrossValidation(spark, train, spec, test if refit else None, materialized=True)
    for k in (*spec.validation.compare_n_splits, *([None] if refit else [])):
        shared.target_stats(k)

    def member(job, cv):
        model, _, params = job
        exp = Experiment(model, params)
        res, oof, _ = cv.evaluate([exp])
        if cv.log.errors:
            raise RuntimeError(str(cv.log.errors))
        full = cv.fit_full(exp)[1] if refit else None
        return oof, full, res, cv

    with ThreadPoolExecutor(max_workers=len(members)) as pool:       # independent distributed jobs
        oofs, tests, results, cvs = zip(*pool.map(member, members, shared.on_each([x for _, x, _ in members])), strict=True)
    tp = written_table(reduce(DataFrame.unionByName, tests), "member_test") if refit else None
    for cv in cvs:
        cv.release()
    return reduce(DataFrame.unionByName, oofs), tp, cvs[0].truth(), [r for res in results for r in res]


_SLOPES = {
    "ridge": lambda p: f"n * cxy / (vx * (n + {p['alpha']}))",
    "lasso": lambda p: f"sign(cxy) * greatest(abs(cxy / sqrt(vx)) - {p['alpha']}, 0) / sqrt(vx)",
    "elasticnet": lambda p: (f"sign(cxy) * greatest(abs(cxy / sqrt(vx)) - {p['alpha'] * p['l1_ratio']}, 0)"
                             f" / (1 + {p['alpha'] * (1 - p['l1_ratio'])}) / sqrt(vx)"),
}


def member_sql(tag: str, model: str, x: str, params: tuple, k: int = 5, folds: str = "folds_5") -> str:
    """CTEs oof_{tag}(id, fold, y, pred) and tp_{tag}(id, pred) of a one-feature scaled linear member."""
    slope = _SLOPES[model](dict(params))
    return f"""
, tr_{tag} AS (SELECT t.id, ln(1 + t.sale_price) AS y, CAST(t.{x} AS DOUBLE) AS x, f.fold FROM train t JOIN {folds} f USING (id)),
st_{tag} AS (SELECT g.tf AS fold, count(*) AS n, avg(y) AS my, avg(x) AS mx, covar_pop(x, y) AS cxy, var_pop(x) AS vx
             FROM tr_{tag} JOIN (SELECT CAST(unnest(range(0, {k})) AS INTEGER) AS tf) g ON tr_{tag}.fold <> g.tf GROUP BY g.tf),
oof_{tag} AS (SELECT tr.id, tr.fold, tr.y, st.my + ({slope}) * (tr.x - st.mx) AS pred
              FROM tr_{tag} tr JOIN st_{tag} st USING (fold)),
fs_{tag} AS (SELECT count(*) AS n, avg(y) AS my, avg(x) AS mx, covar_pop(x, y) AS cxy, var_pop(x) AS vx FROM tr_{tag}),
tp_{tag} AS (SELECT te.id, fs.my + ({slope}) * (CAST(te.{x} AS DOUBLE) - fs.mx) AS pred FROM test te, fs_{tag} fs)"""


def members_sql(members=MEMBERS, k: int = 5) -> str:
    out = folds_sql(k)
    for i, (model, x, params) in enumerate(members):
        out += member_sql(f"m{i}", model, x, params, k, f"folds_{k}")
    return out


def _score_sql(tag: str) -> str:
    return f"(SELECT avg(r) FROM (SELECT sqrt(avg((y - pred) * (y - pred))) AS r FROM oof_{tag} GROUP BY fold))"


@register("cv_evaluate", sql(members_sql(MEMBERS[:1]) + f"""
SELECT {_name_sql('ridge', MEMBERS[0][2])} AS experiment_name, 'ridge' AS model_name,
       round({_score_sql('m0')}, 6) AS primary_score"""))
def cv_evaluate(spark, sf):
    _, _, _, results = run_members(spark, sf, MEMBERS[:1])
    return r6(spark.createDataFrame([(r.experiment_name, r.model_name, r.primary_score) for r in results],
                                    "experiment_name string, model_name string, primary_score double"))


_ALL_X, _ALL_GRID = ["overall_qual", "area_living", "mo_sold", "yr_sold"], [("ridge", (("alpha", 1.0),)), ("ridge", (("alpha", 10.0),)), ("linear_regression", ())]


def _normal_equations_sql(alpha: float, tag: str) -> str:
    """CTE oof_{tag}: per fold the scaled ridge of all of _ALL_X by Gaussian elimination."""
    p = range(len(_ALL_X))
    low = ", ".join([f"avg(x{i}) AS m{i}, stddev_pop(x{i}) AS s{i}, covar_pop(x{i}, y) AS cy{i}" for i in p]
                    + [f"covar_pop(x{i}, x{j}) AS c{i}_{j}" for i in p for j in p if j >= i])
    cells = ", ".join([f"n * c{min(i, j)}_{max(i, j)} / (s{i} * s{j}) + {alpha if i == j else 0.0} AS a{i}_{j}" for i in p for j in p]
                      + [f"n * cy{i} / s{i} AS b{i}" for i in p])
    keep = "fold, my, " + ", ".join(f"m{i}, s{i}" for i in p)
    out = f""", st_{tag} AS (SELECT g.tf AS fold, count(*) AS n, avg(y) AS my, {low}
        FROM tr_all JOIN (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS tf) g ON tr_all.fold <> g.tf GROUP BY g.tf),
e0_{tag} AS (SELECT {keep}, {cells} FROM st_{tag})"""
    for k in p:
        rows = ", ".join([f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" if i > k else f"a{i}_{j}" for i in p for j in p]
                         + [f"b{i} - a{i}_{k} * b{k} / a{k}_{k} AS b{i}" if i > k else f"b{i}" for i in p])
        out += f", e{k + 1}_{tag} AS (SELECT {keep}, {rows} FROM e{k}_{tag})"
    last = f"e{len(_ALL_X)}_{tag}"
    for i in reversed(p):
        done = "".join(f" - a{i}_{j} * w{j}" for j in p if j > i)
        out += f", w{i}_{tag} AS (SELECT *, (b{i}{done}) / a{i}_{i} AS w{i} FROM {last})"
        last = f"w{i}_{tag}"
    terms = " + ".join(f"w.w{i} * (t.x{i} - w.m{i}) / w.s{i}" for i in p)
    return out + f", oof_{tag} AS (SELECT t.fold, t.y, w.my + {terms} AS pred FROM tr_all t JOIN {last} w USING (fold))"


@register("cv_all_features", sql(
    folds_sql(5) + f""", tr_all AS (SELECT {_Y} AS y, f.fold, {', '.join(f'CAST(t.{x} AS DOUBLE) AS x{i}' for i, x in enumerate(_ALL_X))}
        FROM train t JOIN folds_5 f USING (id))""" + "".join(
        _normal_equations_sql(dict(params).get("alpha", 0.0), f"g{i}") for i, (_, params) in enumerate(_ALL_GRID))
    + " UNION ALL ".join(f" SELECT {_name_sql(m, params)} AS experiment_name, round({_score_sql(f'g{i}')}, 6) AS primary_score"
                         for i, (m, params) in enumerate(_ALL_GRID))))
def cv_all_features(spark, sf):
    """A linear grid on several scaled features, every fold solved from one Gram matrix."""
    train, _ = _tt(spark, sf)
    cv = CrossValidation(spark, train.select(ID, TARGET, *_ALL_X), _spec((5,), 5))
    results, _, _ = cv.evaluate([Experiment(m, params) for m, params in _ALL_GRID])
    cv.release()
    return r6(spark.createDataFrame([(r.experiment_name, r.primary_score) for r in results], "experiment_name string, primary_score double"))


@register("metric_fold_mean_std", sql(members_sql(MEMBERS[:1]) + """
SELECT round(avg(r), 6) AS mean_rmse, round(stddev_pop(r), 6) AS std_rmse
FROM (SELECT sqrt(avg((y - pred) * (y - pred))) AS r FROM oof_m0 GROUP BY fold)"""))
def metric_fold_mean_std(spark, sf):
    oof, _, truth, _ = run_members(spark, sf, MEMBERS[:1])
    per_fold = oof.join(truth, ID).groupBy("fold").agg(rmse(F.col("label"), F.col("prediction")).alias("r"))
    return r6(per_fold.agg(F.avg("r").alias("mean_rmse"), F.stddev_pop("r").alias("std_rmse")))


@register("metric_pooled_oof", sql(members_sql(MEMBERS[:1]) + """
SELECT round(sqrt(avg((y - pred) * (y - pred))), 6) AS pooled_rmse FROM oof_m0"""))
def metric_pooled_oof(spark, sf):
    oof, _, truth, _ = run_members(spark, sf, MEMBERS[:1])
    return r6(oof.join(truth, ID).agg(rmse(F.col("label"), F.col("prediction")).alias("pooled_rmse")))


@register("cv_compare_splits", sql(members_sql(MEMBERS[:1], 3).replace("oof_m0", "oof3_m0").replace("tr_m0", "tr3_m0")
                                   .replace("st_m0", "st3_m0").replace("fs_m0", "fs3_m0").replace("tp_m0", "tp3_m0")
                                   + members_sql(MEMBERS[:1], 5) + f"""
SELECT {_name_sql('ridge', MEMBERS[0][2])} AS experiment_name,
       round((SELECT avg(r) FROM (SELECT sqrt(avg((y - pred) * (y - pred))) AS r FROM oof3_m0 GROUP BY fold)), 6)
         AS rmse_3_folds,
       round({_score_sql('m0')}, 6) AS rmse_5_folds"""))
def cv_compare_splits(spark, sf):
    _, _, _, results = run_members(spark, sf, MEMBERS[:1], splits=(3, 5), primary=5)
    return r6(spark.createDataFrame([(r.experiment_name, r.fold_scores[3], r.fold_scores[5]) for r in results],
                                    "experiment_name string, rmse_3_folds double, rmse_5_folds double"))


@register("full_fit_predict", sql(members_sql(MEMBERS[:1]) + " SELECT id, round(pred, 6) AS prediction FROM tp_m0"))
def full_fit_predict(spark, sf):
    _, tp, _, _ = run_members(spark, sf, MEMBERS[:1], refit=True)
    return r6(tp.select(ID, "prediction"))


@register("oof_assemble", sql(folds_sql(5) + """
, cnt AS (SELECT stratum, count(*) AS c FROM strat_5 GROUP BY stratum),
tot AS (SELECT sum(c) AS n, CAST(ceil(0.2 * sum(c)) AS BIGINT) AS nv FROM cnt),
ex AS (SELECT stratum, c * nv / n AS e, floor(c * nv / n) AS fl FROM cnt, tot),
rk AS (SELECT stratum, fl, row_number() OVER (ORDER BY e - fl DESC, stratum) AS rr FROM ex),
quota AS (SELECT stratum, fl + CASE WHEN rr <= (SELECT nv FROM tot) - (SELECT sum(fl) FROM ex) THEN 1 ELSE 0 END AS qv FROM rk),
pos AS (SELECT id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5(concat_ws('|', CAST(id AS VARCHAR), '42')), id) AS p
        FROM strat_5),
ho AS (SELECT id, CAST(CASE WHEN p <= qv THEN 0 ELSE 1 END AS INTEGER) AS fold FROM pos JOIN quota USING (stratum)),
tr AS (SELECT t.id, ln(1 + t.sale_price) AS y, CAST(t.overall_qual AS DOUBLE) AS x, ho.fold FROM train t JOIN ho USING (id)),
st AS (SELECT count(*) AS n, avg(y) AS my, avg(x) AS mx, covar_pop(x, y) AS cxy, var_pop(x) AS vx FROM tr WHERE fold = 1),
oof AS (SELECT tr.id, my + n * cxy / (vx * (n + 10.0)) * (x - mx) AS pred FROM tr, st WHERE tr.fold = 0)
SELECT t.id, round(oof.pred, 6) AS prediction FROM train t LEFT JOIN oof USING (id)"""))
def oof_assemble(spark, sf):
    """Stratified holdout: validation predictions scattered onto all train ids; the rest stay NULL."""
    oof, _, _, _ = run_members(spark, sf, MEMBERS[:1], splits=(1,), primary=1)
    train, _ = _tt(spark, sf)
    return r6(train.select(ID).join(oof.select(ID, "prediction"), ID, "left"))


_NAMES = [_member_name(m, p) for m, _, p in MEMBERS]


def _wide_sql(source: str = "oof") -> str:
    return ("SELECT id, " + ", ".join(f"round(max(CASE WHEN e = {i} THEN pred END), 6) AS \"{n}\""
                                      for i, n in enumerate(_NAMES))
            + " FROM (" + " UNION ALL ".join(f"SELECT id, {i} AS e, pred FROM {source}_m{i}"
                                              for i in range(len(MEMBERS))) + ") GROUP BY id")


@register("members_bind", sql(members_sql() + " " + _wide_sql("oof")))
def members_bind(spark, sf):
    oof, _, _, _ = run_members(spark, sf)
    return r6(ens.wide(oof, ID, _NAMES))


@register("ensemble_members", sql(members_sql() + " " + " UNION ALL ".join(
    f"SELECT {_name_sql(m, p)} AS experiment FROM (SELECT 1) WHERE EXISTS (SELECT 1 FROM oof_m{i}) "
    f"AND EXISTS (SELECT 1 FROM tp_m{i})" for i, (m, _, p) in enumerate(MEMBERS))))
def ensemble_members(spark, sf):
    oof, tp, _, _ = run_members(spark, sf, refit=True)
    return spark.createDataFrame([(e,) for e in ens.usable_members(oof, tp, _NAMES)], "experiment string")


_LONG_OOF = " UNION ALL ".join(f"SELECT id, y, pred FROM oof_m{i}" for i in range(len(MEMBERS)))
_LONG_TP = " UNION ALL ".join(f"SELECT id, pred FROM tp_m{i}" for i in range(len(MEMBERS)))


@register("ensemble_average", sql(members_sql() + f" SELECT id, round(avg(pred), 6) AS prediction FROM ({_LONG_OOF}) "
                                                   "GROUP BY id"))
def ensemble_average(spark, sf):
    oof, _, _, _ = run_members(spark, sf)
    return r6(ens.blend(oof, ID, _NAMES, "mean"))


@register("ensemble_median", sql(members_sql() + f" SELECT id, round(median(pred), 6) AS prediction FROM ({_LONG_OOF}) "
                                                  "GROUP BY id"))
def ensemble_median(spark, sf):
    oof, _, _, _ = run_members(spark, sf)
    return r6(ens.blend(oof, ID, _NAMES, "median"))


def _ridge3_sql(alpha: float) -> str:
    """Ridge on w(y, p0, p1, p2): 3x3 centred normal equations by Cramer's rule, as ``coef``."""
    return f"""
, m AS (SELECT count(*) AS n, avg(y) AS my, avg(p0) AS a0, avg(p1) AS a1, avg(p2) AS a2,
             count(*) * var_pop(p0) + {alpha} AS s00, count(*) * var_pop(p1) + {alpha} AS s11,
             count(*) * var_pop(p2) + {alpha} AS s22, count(*) * covar_pop(p0, p1) AS s01,
             count(*) * covar_pop(p0, p2) AS s02, count(*) * covar_pop(p1, p2) AS s12,
             count(*) * covar_pop(p0, y) AS r0, count(*) * covar_pop(p1, y) AS r1, count(*) * covar_pop(p2, y) AS r2
      FROM w),
d AS (SELECT *, s00 * (s11 * s22 - s12 * s12) - s01 * (s01 * s22 - s12 * s02) + s02 * (s01 * s12 - s11 * s02) AS det
      FROM m),
coef AS (SELECT my, a0, a1, a2,
  (r0 * (s11 * s22 - s12 * s12) - s01 * (r1 * s22 - s12 * r2) + s02 * (r1 * s12 - s11 * r2)) / det AS w0,
  (s00 * (r1 * s22 - s12 * r2) - r0 * (s01 * s22 - s12 * s02) + s02 * (s01 * r2 - r1 * s02)) / det AS w1,
  (s00 * (s11 * r2 - r1 * s12) - s01 * (s01 * r2 - r1 * s02) + r0 * (s01 * s12 - s11 * s02)) / det AS w2 FROM d)"""


def _stack_sql(alpha: float = 1.0) -> str:
    """Meta ridge on the three member columns."""
    return f"""
, w AS (SELECT o0.id, o0.y, o0.pred AS p0, o1.pred AS p1, o2.pred AS p2 FROM oof_m0 o0 JOIN oof_m1 o1 USING (id)
        JOIN oof_m2 o2 USING (id)){_ridge3_sql(alpha)},
stack_oof AS (SELECT w.id, w.y, my + w0 * (p0 - a0) + w1 * (p1 - a1) + w2 * (p2 - a2) AS pred FROM w, coef),
stack_tp AS (SELECT t0.id, my + w0 * (t0.pred - a0) + w1 * (t1.pred - a1) + w2 * (t2.pred - a2) AS pred
             FROM tp_m0 t0 JOIN tp_m1 t1 USING (id) JOIN tp_m2 t2 USING (id), coef)"""


# The members agree with their closed forms to ~1e-13; the 3 x 3 meta solve (MLlib
# Cholesky vs Cramer's rule here) agrees to ~1e-10 relative, so stacked outputs are
# compared at 5 decimals on the log scale and in whole currency units on prices.
@register("ensemble_stacking", sql(members_sql() + _stack_sql() + " SELECT id, round(pred, 5) AS prediction FROM stack_oof"))
def ensemble_stacking(spark, sf):
    oof, tp, truth, _ = run_members(spark, sf, refit=True)
    stacked_oof, _ = ens.stack(oof, tp, truth, ID, _NAMES, "ridge", {"alpha": 1.0})
    return r6(stacked_oof, 5)


def _stack_folds_sql(alpha: float = 1.0) -> str:
    """Meta ridge of each fold's training rows; stack_fold(id, fold, y, pred) on the rows it has not seen."""
    pair = lambda i, j: f"s{min(i, j)}{max(i, j)}"
    p = range(3)
    cof = {(i, j): "({} * {} - {} * {})".format(pair((i + 1) % 3, (j + 1) % 3), pair((i + 2) % 3, (j + 2) % 3),
                                              pair((i + 1) % 3, (j + 2) % 3), pair((i + 2) % 3, (j + 1) % 3)) for i in p for j in p}
    sums = ", ".join([f"avg(p{i}) AS a{i}, count(*) * covar_pop(p{i}, y) AS r{i}" for i in p]
                     + [f"count(*) * covar_pop(p{i}, p{j}) + {alpha if i == j else 0.0} AS s{i}{j}" for i in p for j in p if j >= i])
    det = " + ".join(f"s0{j} * {cof[0, j]}" for j in p)
    weights = ", ".join("(" + " + ".join(f"r{i} * {cof[i, j]}" for i in p) + f") / ({det}) AS w{j}" for j in p)
    return f"""
, wf AS (SELECT o0.id, o0.fold, o0.y, o0.pred AS p0, o1.pred AS p1, o2.pred AS p2 FROM oof_m0 o0 JOIN oof_m1 o1 USING (id)
        JOIN oof_m2 o2 USING (id)),
mf AS (SELECT g.tf AS fold, avg(y) AS my, {sums}
       FROM wf JOIN (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS tf) g ON wf.fold <> g.tf GROUP BY g.tf),
cf AS (SELECT fold, my, a0, a1, a2, {weights} FROM mf),
stack_fold AS (SELECT wf.id, fold, wf.y, my + w0 * (p0 - a0) + w1 * (p1 - a1) + w2 * (p2 - a2) AS pred FROM wf JOIN cf USING (fold))"""


@register("ensemble_stacking_oof", sql(members_sql() + _stack_folds_sql() + " SELECT id, fold, round(pred, 5) AS prediction FROM stack_fold"))
def ensemble_stacking_oof(spark, sf):
    """The stack's predictions of each fold's rows by a meta-model of the other folds."""
    oof, _, truth, _ = run_members(spark, sf)
    return r6(ens.stack_out_of_fold(oof, truth, ID, _NAMES, "ridge", {"alpha": 1.0}), 5)


_POOLED = "(SELECT sqrt(avg((y - pred) * (y - pred))) FROM {})"


@register("ensemble_stacking_oof_score", sql(members_sql() + _stack_sql() + _stack_folds_sql() + f"""
SELECT 'ensemble_stacking_ridge' AS experiment_name, round({_POOLED.format('stack_oof')}, 6) AS in_sample_score,
       round({_POOLED.format('stack_fold')}, 6) AS oof_score"""))
def ensemble_stacking_oof_score(spark, sf):
    """In-sample score of the stack beside the score on rows its meta-model has not seen."""
    oof, tp, truth, _ = run_members(spark, sf, refit=True)
    seen, _ = ens.stack(oof, tp, truth, ID, _NAMES, "ridge", {"alpha": 1.0})
    unseen = ens.stack_out_of_fold(oof, truth, ID, _NAMES, "ridge", {"alpha": 1.0})
    row = ("ensemble_stacking_ridge", ens.pooled_score(seen, truth, ID), ens.pooled_score(unseen, truth, ID))
    return r6(spark.createDataFrame([row], "experiment_name string, in_sample_score double, oof_score double"))


def _board_sql() -> str:
    singles = " UNION ALL ".join(f"SELECT {_name_sql(m, p)} AS experiment_name, '{m}' AS model_name, "
                                 f"{_score_sql(f'm{i}')} AS primary_score" for i, (m, _, p) in enumerate(MEMBERS))
    pooled = "sqrt(avg((y - pred) * (y - pred)))"
    blends = f"""
SELECT 'ensemble_average', 'ensemble_average', (SELECT {pooled} FROM (SELECT id, any_value(y) AS y, avg(pred) AS pred
        FROM ({_LONG_OOF}) GROUP BY id))
UNION ALL SELECT 'ensemble_voting', 'ensemble_voting', (SELECT {pooled} FROM (SELECT id, any_value(y) AS y,
        median(pred) AS pred FROM ({_LONG_OOF}) GROUP BY id))
UNION ALL SELECT 'ensemble_stacking_ridge', 'ensemble_stacking_ridge', (SELECT {pooled} FROM stack_oof)"""
    return members_sql() + _stack_sql() + f", board AS ({singles} UNION ALL {blends})"


def run_board(spark, sf):
    """Leaderboard rows (singles by mean fold RMSE, blends by pooled RMSE, stack in-sample) + test predictions."""
    oof, tp, truth, results = run_members(spark, sf, refit=True)
    rows = [(r.experiment_name, r.model_name, r.primary_score) for r in results]
    test_by_name = {n: tp.filter(F.col("experiment") == n).select(ID, "prediction") for n in _NAMES}
    for name, how in (("ensemble_average", "mean"), ("ensemble_voting", "median")):
        b = ens.blend(oof, ID, _NAMES, how)
        rows.append((name, name, ens.pooled_score(b, truth, ID)))
        test_by_name[name] = ens.blend(tp, ID, _NAMES, how)
    s_oof, s_tp = ens.stack(oof, tp, truth, ID, _NAMES, "ridge", {"alpha": 1.0})
    rows.append(("ensemble_stacking_ridge", "ensemble_stacking_ridge", ens.pooled_score(s_oof, truth, ID)))
    test_by_name["ensemble_stacking_ridge"] = s_tp
    board = spark.createDataFrame(rows, "experiment_name string, model_name string, primary_score double")
    return board, test_by_name


@register("leaderboard", sql(_board_sql() + " SELECT experiment_name, model_name, round(primary_score, 6) AS primary_score "
                                            "FROM board"))
def leaderboard_q(spark, sf):
    board, _ = run_board(spark, sf)
    return r6(board.orderBy("primary_score", "experiment_name"))


@register("leaderboard_union", sql(_board_sql() + " SELECT experiment_name, round(primary_score, 6) AS primary_score "
                                                  "FROM board"))
def leaderboard_union(spark, sf):
    """Singles' board appended with the ensembles' rows (union by name)."""
    board, _ = run_board(spark, sf)
    singles = board.filter(~F.col("experiment_name").startswith("ensemble_"))
    blends = board.filter(F.col("experiment_name").startswith("ensemble_"))
    return r6(singles.select("experiment_name", "primary_score").unionByName(blends.select("experiment_name",
                                                                                          "primary_score")))


@register("best_experiment", sql(_board_sql() + " SELECT experiment_name, round(primary_score, 6) AS primary_score "
                                                "FROM board ORDER BY primary_score, experiment_name LIMIT 1"))
def best_experiment(spark, sf):
    board, _ = run_board(spark, sf)
    return r6(ens.best(board).select("experiment_name", "primary_score"))


@register("submission", sql(_board_sql() + f"""
, bestx AS (SELECT experiment_name FROM board ORDER BY primary_score, experiment_name LIMIT 1),
cands AS ({' UNION ALL '.join(f"SELECT {_name_sql(m, p)} AS e, id, pred FROM tp_m{i}" for i, (m, _, p) in enumerate(MEMBERS))}
  UNION ALL SELECT 'ensemble_average', id, avg(pred) FROM ({_LONG_TP}) GROUP BY id
  UNION ALL SELECT 'ensemble_voting', id, median(pred) FROM ({_LONG_TP}) GROUP BY id
  UNION ALL SELECT 'ensemble_stacking_ridge', id, pred FROM stack_tp)
SELECT id, round(greatest(exp(pred) - 1, 0), 0) AS sale_price FROM cands JOIN bestx ON cands.e = bestx.experiment_name"""))
def submission_q(spark, sf):
    board, tests = run_board(spark, sf)
    name = ens.best(board).first()["experiment_name"]
    return ens.submission(tests[name], ID, TARGET, "log1p").select(ID, F.round(TARGET, 0).alias(TARGET))

# ------------------------------------------------------------------ X2 / M5: a user's metric


_MAPE = "avg(abs(exp(pred) - exp(y)) / nullif(exp(y) - 1, 0))"


def _mape_board_sql() -> str:
    singles = " UNION ALL ".join(f"SELECT {_name_sql(m, p)} AS experiment_name, (SELECT avg(r) FROM (SELECT {_MAPE} AS r FROM oof_m{i} "
                                 f"GROUP BY fold)) AS score" for i, (m, _, p) in enumerate(MEMBERS))
    return members_sql() + f""", mape_board AS ({singles} UNION ALL SELECT 'ensemble_average', (SELECT {_MAPE}
        FROM (SELECT id, any_value(y) AS y, avg(pred) AS pred FROM ({_LONG_OOF}) GROUP BY id)))"""


def _mape_board(spark, sf):
    from plinth.functions.metrics import MAPE
    oof, _, truth, results = run_members(spark, sf, metric=MAPE)
    score = ens.pooled_score(ens.blend(oof, ID, _NAMES, "mean"), truth, ID, MAPE, "log1p")
    results.append(ExperimentResult("ensemble_average", "ensemble_average", {"members": _NAMES}, score, {5: score}, "pooled_oof_mape"))
    return ens.leaderboard(spark, results, [5], MAPE), MAPE


@register("metric_custom_leaderboard", sql(_mape_board_sql() + """
SELECT experiment_name, round(score, 6) AS primary_score, round(score, 6) AS mape_5_folds FROM mape_board"""))
def metric_custom_leaderboard(spark, sf):
    """Cross-validation, blend and leaderboard by mean absolute percentage error on the target's own scale."""
    board, _ = _mape_board(spark, sf)
    return r6(board.select("experiment_name", "primary_score", "mape_5_folds"))


@register("metric_custom_best", sql(_mape_board_sql() + """
SELECT experiment_name, round(score, 6) AS primary_score FROM mape_board ORDER BY score, experiment_name LIMIT 1"""))
def metric_custom_best(spark, sf):
    board, metric = _mape_board(spark, sf)
    return r6(ens.best(board, metric).select("experiment_name", "primary_score"))

# ------------------------------------------------------------------ T3 / M1 / M2: target wrapper


def _wrapped_preds(spark, sf):
    train, test = _tt(spark, sf)
    st = _log_y(train).agg(F.count(F.lit(1)), F.stddev_pop("y")).first()
    est = TargetTransformRegressor(build_estimator("linear_regression", {}, FitContext(st[0], st[1]),
                                                   label_col=TARGET), "log1p", label_col=TARGET)
    model = Pipeline(stages=[VectorAssembler(inputCols=["overall_qual"], outputCol=FEATURES), est]).fit(train)
    return model.transform(test).select(ID, "prediction")


_T3 = f""", ols AS (SELECT regr_intercept({_Y}, overall_qual::DOUBLE) AS b0, regr_slope({_Y}, overall_qual::DOUBLE) AS b1
                FROM train),
pt AS (SELECT test.id, exp(b0 + b1 * overall_qual) - 1 AS pred FROM test, ols)"""


@register("target_wrapped_model", sql(_T3 + " SELECT id, round(pred, 4) AS prediction FROM pt"))
def target_wrapped_model(spark, sf):
    return _wrapped_preds(spark, sf).select(ID, F.round("prediction", 4).alias("prediction"))


@register("metric_rmse", sql(_T3 + " SELECT round(sqrt(avg(power(ln(1 + truth.sale_price) - ln(1 + pred), 2))), 6) "
                                   "AS rmse FROM pt JOIN truth USING (id)"))
def metric_rmse(spark, sf):
    p = _wrapped_preds(spark, sf).join(test_truth(spark, sf), ID)
    return r6(p.agg(rmse(F.log1p(TARGET), F.log1p("prediction")).alias("rmse")))


@register("metric_rmsle", sql(_T3 + " SELECT round(sqrt(avg(power(ln(1 + truth.sale_price) - ln(1 + greatest(pred, 0)), 2))), 6)"
                                    " AS rmsle FROM pt JOIN truth USING (id)"))
def metric_rmsle(spark, sf):
    p = _wrapped_preds(spark, sf).join(test_truth(spark, sf), ID)
    return r6(p.agg(rmsle(c(TARGET), F.col("prediction")).alias("rmsle")))

# ------------------------------------------------------------------ G5 / E5 / E8: the exploratory flow


# Both members see the same single feature; with a tiny lasso penalty the two
# prediction columns are nearly collinear and the meta-ridge is ill-posed, so
# the lasso member gets a penalty that shrinks its slope visibly.
_NB_MEMBERS = [("ridge", {"alpha": 1.0}), ("lasso", {"alpha": 0.5, "max_iter": 10000})]
_NB_SLOPES = {"ridge": "cxy / (vx + 1.0 / n)", "lasso": "sign(cxy) * greatest(abs(cxy) - 0.5, 0) / vx"}


def _nb_sql() -> str:
    """Per member and fold (plain k-fold): raw one-feature fit on log1p(y); OOF and test on the original scale."""
    out = kfold_sql(5)
    for i, (m, _) in enumerate(_NB_MEMBERS):
        out += f"""
, nbtr_{i} AS (SELECT t.id, t.sale_price AS y, ln(1 + t.sale_price) AS ly, CAST(t.overall_qual AS DOUBLE) AS x, k.fold
              FROM train t JOIN kf_5 k USING (id)),
nbst_{i} AS (SELECT g.tf AS fold, count(*) AS n, avg(ly) AS my, avg(x) AS mx, covar_pop(x, ly) AS cxy, var_pop(x) AS vx
             FROM nbtr_{i} JOIN (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS tf) g ON nbtr_{i}.fold <> g.tf GROUP BY g.tf),
nboof_{i} AS (SELECT tr.id, tr.fold, tr.y, exp(st.my + ({_NB_SLOPES[m]}) * (tr.x - st.mx)) - 1 AS pred
              FROM nbtr_{i} tr JOIN nbst_{i} st USING (fold)),
nbtp_{i} AS (SELECT te.id, avg(exp(st.my + ({_NB_SLOPES[m]}) * (CAST(te.overall_qual AS DOUBLE) - st.mx)) - 1) AS pred
             FROM test te, nbst_{i} st GROUP BY te.id)"""
    out += """
, nbw AS (SELECT a.id, a.y, a.pred AS p0, b.pred AS p1 FROM nboof_0 a JOIN nboof_1 b USING (id)),
nbm AS (SELECT count(*) AS n, avg(y) AS my, avg(p0) AS a0, avg(p1) AS a1, count(*) * var_pop(p0) + 1.0 AS a,
               count(*) * covar_pop(p0, p1) AS b, count(*) * var_pop(p1) + 1.0 AS d, count(*) * covar_pop(p0, y) AS s0,
               count(*) * covar_pop(p1, y) AS s1 FROM nbw),
nbc AS (SELECT my, a0, a1, (d * s0 - b * s1) / (a * d - b * b) AS w0, (a * s1 - b * s0) / (a * d - b * b) AS w1 FROM nbm),
nbstack_oof AS (SELECT nbw.id, nbw.y, my + w0 * (p0 - a0) + w1 * (p1 - a1) AS pred FROM nbw, nbc),
nbstack_tp AS (SELECT a.id, my + w0 * (a.pred - a0) + w1 * (b.pred - a1) AS pred FROM nbtp_0 a JOIN nbtp_1 b USING (id), nbc),
nbscore AS (SELECT i, avg(r) AS mean_rmsle, stddev_pop(r) AS std_rmsle FROM (""" + " UNION ALL ".join(
        f"SELECT {i} AS i, fold, sqrt(avg(power(ln(1 + y) - ln(1 + greatest(pred, 0)), 2))) AS r FROM nboof_{i} GROUP BY fold"
        for i in range(len(_NB_MEMBERS))) + ") GROUP BY i)"
    return out


def _nb_frames(spark, sf):
    return _one_feature(*_tt(spark, sf))


def _one_feature(train, test):
    return train.select(ID, TARGET, F.col("overall_qual").cast("double").alias("overall_qual")), \
        test.select(ID, F.col("overall_qual").cast("double").alias("overall_qual"))


@register("cv_rmsle", sql(_nb_sql() + " SELECT CASE i WHEN 0 THEN 'ridge' ELSE 'lasso' END AS model, "
                                      "round(mean_rmsle, 6) AS mean_rmsle, round(std_rmsle, 6) AS std_rmsle FROM nbscore"))
def cv_rmsle(spark, sf):
    X, _ = _nb_frames(spark, sf)
    rows = []
    for m, p in _NB_MEMBERS:
        mean, std, _ = evaluate_model(X, ["overall_qual"], ID, TARGET, m, p, SPEC)
        rows.append((m, mean, std))
    return r6(spark.createDataFrame(rows, "model string, mean_rmsle double, std_rmsle double"))


def _nb_stack(spark, sf):
    X, Xt = _nb_frames(spark, sf)
    return fold_mean_stack(X, Xt, ["overall_qual"], ID, TARGET, _NB_MEMBERS, SPEC)


@register("ensemble_fold_mean_stack", sql(_nb_sql() + " SELECT id, round(pred, 2) AS prediction FROM nbstack_tp"))
def ensemble_fold_mean_stack(spark, sf):
    return _nb_stack(spark, sf)["test"].select(ID, F.round("prediction", 2).alias("prediction"))


@register("choose_stack_or_single", sql(_nb_sql() + """
, st AS (SELECT sqrt(avg(power(ln(1 + y) - ln(1 + greatest(pred, 0)), 2))) AS s FROM nbstack_oof),
single AS (SELECT CASE i WHEN 0 THEN 'ridge' ELSE 'lasso' END AS model, mean_rmsle FROM nbscore
           ORDER BY mean_rmsle, model LIMIT 1)
SELECT CASE WHEN s <= mean_rmsle THEN 'stacking' ELSE model END AS choice,
       round(CASE WHEN s <= mean_rmsle THEN s ELSE mean_rmsle END, 6) AS score FROM st, single"""))
def choose_stack_or_single(spark, sf):
    X, _ = _nb_frames(spark, sf)
    singles = {m: evaluate_model(X, ["overall_qual"], ID, TARGET, m, p, SPEC)[0] for m, p in _NB_MEMBERS}
    choice, score = ens.choose_stack_or_single(_nb_stack(spark, sf)["score"], singles)
    return r6(spark.createDataFrame([(choice, score)], "choice string, score double"))

# ------------------------------------------------------------------ rows-only: trees, full recipe, sinks


def _full_recipe(spark, sf, model: str, params: dict):
    from dataclasses import replace
    train, test = _written_tt(spark, sf)
    spec = replace(SPEC, validation=ValidationSpec(compare_n_splits=(5,)))
    cv = CrossValidation(spark, train, spec, test, folds=False, materialized=True)
    _, preds = cv.fit_full(Experiment(model, tuple(sorted(params.items()))))
    return preds.select(ID, "prediction")


@register("recipe_ridge")
def recipe_ridge(spark, sf):
    """Cleaner, imputers, scaler, one-hot and ridge(alpha=10) on all fx features; test predictions."""
    return _full_recipe(spark, sf, "ridge", {"alpha": 10.0})


@register("recipe_native_cat")
def recipe_native_cat(spark, sf):
    """Median and "Missing" fills, categories as nominal indices, boosted trees."""
    return _full_recipe(spark, sf, "catboost", {"iterations": 30, "learning_rate": 0.1, "depth": 4})


@register("preprocess_vector")
def preprocess_vector(spark, sf):
    train, test = _tt(spark, sf)
    from plinth.operators.features import add_features
    feat = add_features(train, SPEC.features)
    cols = [x for x in feat.columns if x not in (ID, TARGET)]
    state = fit_recipe(feat, cols, SPEC.prep, scale=True)[None]
    from pyspark.ml import PipelineModel
    prep = PipelineModel(recipe_stages(state, feat))
    return prep.transform(add_features(test, SPEC.features)).select(ID, vector_to_array(FEATURES).alias("features"))


@register("model_tree")
def model_tree(spark, sf):
    return _full_recipe(spark, sf, "decision_tree", {"max_depth": 6})


@register("model_forest")
def model_forest(spark, sf):
    """The forest of the default grid: 600 trees without a limit of depth, on all features; test predictions."""
    return _full_recipe(spark, sf, "random_forest", {"n_estimators": 600, "max_depth": None, "min_samples_leaf": 1, "random_state": 42})


@register("model_gbt")
def model_gbt(spark, sf):
    return _full_recipe(spark, sf, "xgboost", {"n_estimators": 30, "learning_rate": 0.1, "max_depth": 4,
                                               "subsample": 0.8, "colsample_bytree": 0.8, "random_state": 42})


@register("sink_parquet_oof", sql(members_sql() + " " + " UNION ALL ".join(
    f"SELECT id, fold, round(pred, 6) AS prediction, {_name_sql(m, p)} AS experiment FROM oof_m{i}"
    for i, (m, _, p) in enumerate(MEMBERS))))
def sink_parquet_oof(spark, sf):
    """Out-of-fold predictions written partitioned by experiment, read back."""
    oof, _, _, _ = run_members(spark, sf)
    path = work_path(spark, "oof_sink")
    oof.write.mode("overwrite").partitionBy("experiment").parquet(path)
    return r6(spark.read.parquet(path))


@register("best_result_json", sql(_board_sql() + " SELECT experiment_name, model_name, round(primary_score, 6) AS "
                                  "primary_score FROM board ORDER BY primary_score, experiment_name LIMIT 1"))
def best_result_json(spark, sf):
    """The best entry written as a JSON document and read back."""
    board, _ = run_board(spark, sf)
    path = work_path(spark, "best_json")
    top = ens.best(board).select("experiment_name", "model_name", "primary_score")
    top.write.json(path)
    return r6(spark.read.schema(top.schema).json(path))

# ------------------------------------------------------------------ closed forms: id as feature, trees of depth 1


@register("cv_id_feature", sql(folds_sql(5) + member_sql("m0", "ridge", "id", MEMBERS[0][2], 5, "folds_5")
                               + " SELECT id, fold, round(pred, 6) AS prediction FROM oof_m0"))
def cv_id_feature(spark, sf):
    """Ridge on the id alone: the feature is scaled, the row keys stay as they are."""
    from dataclasses import replace
    spec = _spec()
    spec = replace(spec, data=replace(spec.data, id_as_feature=True))
    train, _ = _tt(spark, sf)
    cv = CrossValidation(spark, train.select(ID, TARGET), spec)
    _, oof, _ = cv.evaluate([Experiment("ridge", MEMBERS[0][2])])
    cv.release()
    return r6(oof.select(ID, "fold", "prediction"))


def _refit_on(spark, sf, cols: list[str], model: str, params: dict) -> DataFrame:
    """Test predictions of one model fitted through the whole recipe on a few raw columns."""
    train, test = _tt(spark, sf)
    cv = CrossValidation(spark, train.select(ID, TARGET, *cols), _spec(), test.select(ID, *cols), folds=False)
    _, preds = cv.fit_full(Experiment(model, tuple(sorted(params.items()))))
    return r6(preds.select(ID, "prediction"))


def _stump_sql(tag: str, source: str) -> str:
    """stump_{tag}(cut, lo, hi): the best split of source(x, y) by squared error."""
    return f"""
, g_{tag} AS (SELECT x, count(*) AS n, sum(y) AS s FROM {source} GROUP BY x),
c_{tag} AS (SELECT x, sum(n) OVER (ORDER BY x) AS nl, sum(s) OVER (ORDER BY x) AS sl, sum(n) OVER () AS n,
                   sum(s) OVER () AS s FROM g_{tag}),
stump_{tag} AS (SELECT x AS cut, sl / nl AS lo, (s - sl) / (n - nl) AS hi FROM c_{tag} WHERE nl < n
                ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, x LIMIT 1)"""


_QUAL = f", q AS (SELECT overall_qual AS x, {_Y} AS y FROM train)" + _stump_sql("a", "q")
_STUMP = sql(_QUAL + """
SELECT id, round(CASE WHEN overall_qual <= cut THEN lo ELSE hi END, 6) AS prediction FROM test, stump_a""")


@register("tree_stump", _STUMP)
def tree_stump(spark, sf):
    """A decision tree of depth 1 on one feature."""
    return _refit_on(spark, sf, ["overall_qual"], "decision_tree", {"max_depth": 1})


@register("forest_stump", _STUMP)
def forest_stump(spark, sf):
    """A forest of one tree on all rows."""
    return _refit_on(spark, sf, ["overall_qual"], "random_forest",
                     {"n_estimators": 1, "max_depth": 1, "bootstrap": False, "random_state": 42})


@register("boost_stumps", sql(_QUAL + """
, f AS (SELECT x, 2 * (y - CASE WHEN x <= cut THEN lo ELSE hi END) AS y FROM q, stump_a)""" + _stump_sql("b", "f") + """
SELECT id, round(CASE WHEN overall_qual <= a.cut THEN a.lo ELSE a.hi END
                 + 0.1 * CASE WHEN overall_qual <= b.cut THEN b.lo ELSE b.hi END, 6) AS prediction
FROM test, stump_a a, stump_b b"""))
def boost_stumps(spark, sf):
    """Two boosting rounds of depth 1; the second fits twice the residual (the loss gradient)."""
    return _refit_on(spark, sf, ["overall_qual"], "xgboost",
                     {"n_estimators": 2, "learning_rate": 0.1, "max_depth": 1, "random_state": 42})


@register("native_cat_stump", sql(f"""
, q AS (SELECT coalesce(alley, 'Missing') AS v, avg({_Y}) OVER (PARTITION BY coalesce(alley, 'Missing')) AS x, {_Y} AS y
        FROM train)""" + _stump_sql("a", "q") + """
, means AS (SELECT DISTINCT v, x FROM q)
SELECT test.id, round(CASE WHEN means.x <= cut THEN lo ELSE hi END, 6) AS prediction
FROM test LEFT JOIN means ON coalesce(alley, 'Missing') = v, stump_a"""))
def native_cat_stump(spark, sf):
    """The native-category recipe: gaps become a category of their own; one split of depth 1."""
    return _refit_on(spark, sf, ["alley"], "catboost", {"iterations": 1, "learning_rate": 0.1, "depth": 1})


_ONEHOT = """(CASE WHEN coalesce(alley, mode_a) = '{v}' THEN 1.0 ELSE 0.0 END)"""


@register("ridge_onehot", sql(f"""
, st AS (SELECT (SELECT alley FROM train WHERE alley IS NOT NULL GROUP BY alley ORDER BY count(*) DESC, alley LIMIT 1) AS mode_a,
               (SELECT median(year_built) FROM train) AS med),
sc AS (SELECT avg(coalesce(year_built, med)) AS mu, stddev_pop(coalesce(year_built, med)) AS sd FROM train, st),
w AS (SELECT {_Y} AS y, (coalesce(year_built, med) - mu) / sd AS p0, {_ONEHOT.format(v='F')} AS p1,
             {_ONEHOT.format(v='O')} AS p2 FROM train, st, sc){_ridge3_sql(10.0)}
SELECT id, round(my + w0 * ((coalesce(year_built, med) - mu) / sd - a0) + w1 * ({_ONEHOT.format(v='F')} - a1)
                 + w2 * ({_ONEHOT.format(v='O')} - a2), 6) AS prediction FROM test, st, sc, coef"""))
def ridge_onehot(spark, sf):
    """Median and mode fills, scaler, one-hot and ridge through the whole recipe on two columns."""
    return _refit_on(spark, sf, ["year_built", "alley"], "ridge", {"alpha": 10.0})


_SAVED = "SELECT id, round(p, 6) AS prediction, round(greatest(exp(p) - 1, 0), 0) AS sale_price FROM (SELECT id, my"


@register("saved_model_predict", O["ridge_onehot"].replace("SELECT id, round(my", _SAVED, 1).replace(", 6) AS prediction FROM test", " AS p FROM test") + ")")
def saved_model_predict(spark, sf):
    """A refit saved as one pipeline, loaded again and asked for raw rows: prediction and price."""
    from pyspark.ml import PipelineModel

    from plinth.plans.run import standalone
    train, test = _tt(spark, sf)
    cols, spec = ["year_built", "alley"], _spec()
    cv = CrossValidation(spark, train.select(ID, TARGET, *cols), spec, folds=False)
    fitted, _ = cv.fit_full(Experiment("ridge", (("alpha", 10.0),)))
    path = work_path(spark, "model")
    standalone(fitted, spec).save(path)
    cv.release()
    found = PipelineModel.load(path).transform(test.select(ID, *cols))
    return found.select(ID, F.round("prediction", 6).alias("prediction"), F.round(TARGET, 0).alias(TARGET))


QUERIES, ORACLE = Q, O

# ------------------------------------------------------------------ Q: quality report of the exploratory flow


_EXPECTED_DERIVED = ["sale_month_index", "years_since_sale_2010", "total_usable_area", "total_bathrooms",
                     "house_age_at_sale"]


def _quality_sql() -> str:
    from plinth.plans.catalog_data import CATEGORICAL, NUMERIC_FE_ORDERED, _cat_long_sql
    dummies = (f"(SELECT count(*) FROM (SELECT DISTINCT column, coalesce(value, 'Missing') FROM "
               f"({_cat_long_sql('u', CATEGORICAL)})))")
    return sql(_nb_sql() + f"""
, u AS (SELECT * EXCLUDE (sale_price) FROM train_fe UNION ALL SELECT * FROM test_fe),
n AS (SELECT (SELECT count(*) FROM train) AS ntr, (SELECT count(*) FROM test) AS nte,
             {len(NUMERIC_FE_ORDERED)} + {dummies} AS w)
SELECT * FROM (VALUES ('required_columns', true, 2)) v(check_name, ok, value)
UNION ALL SELECT 'train_rows_kept', (SELECT count(*) FROM train_fe) = ntr, ntr FROM n
UNION ALL SELECT 'test_rows_kept', (SELECT count(*) FROM test_fe) = nte, nte FROM n
UNION ALL SELECT 'same_width', true, w FROM n
UNION ALL SELECT 'no_missing_after_prep', true, 0
UNION ALL SELECT 'derived_columns_present', true, {len(_EXPECTED_DERIVED)}
UNION ALL SELECT 'leaderboard_finite', true, {len(_NB_MEMBERS) + 1}
UNION ALL SELECT 'oof_covers_train', count(DISTINCT id) = any_value(ntr) AND count_if(pred IS NULL OR NOT isfinite(pred)) = 0,
                 count(DISTINCT id) FROM nbstack_oof, n
UNION ALL SELECT 'member_test_covers_test', count_if(p.id IS NULL) = 0, count(p.id)
          FROM test LEFT JOIN (SELECT DISTINCT id FROM nbtp_0) p ON test.id = p.id
UNION ALL SELECT 'predictions_finite_nonneg', count_if(isfinite(pred)) = any_value(nte), CAST(count_if(isfinite(pred)) AS BIGINT) FROM nbstack_tp, n
UNION ALL SELECT 'submission_shape', count(*) = any_value(nte), count(*) FROM nbstack_tp, n""").replace("SELECT * FROM (VALUES", "SELECT check_name, ok, CAST(value AS BIGINT) AS value FROM (VALUES")


@register("quality_report", _quality_sql())
def quality_report_q(spark, sf):
    """Checks of the exploratory flow: dense prep, leaderboard, stack OOF and test rows, submission."""
    from plinth.operators.quality import quality_report
    from plinth.plans.notebook import prepare_dense
    from plinth.operators.features import add_features
    train, test = (written_table(x, "fx") for x in _tt(spark, sf))     # read by every check
    X, Xt, _ = prepare_dense(train, test, SPEC)
    X_one, Xt_one = _one_feature(train, test)
    rows = [(m, evaluate_model(X_one, ["overall_qual"], ID, TARGET, m, p, SPEC)[0]) for m, p in _NB_MEMBERS]
    st = fold_mean_stack(X_one, Xt_one, ["overall_qual"], ID, TARGET, _NB_MEMBERS, SPEC)
    rows.append(("stacking_ridge_meta", st["score"]))
    board = spark.createDataFrame(rows, "model string, mean_rmsle double")
    oof = st["oof"]
    preds = st["test"].select(ID, F.greatest(F.col("prediction"), F.lit(0.0)).alias("prediction"))
    sub = preds.select(ID, F.col("prediction").alias(TARGET))
    member_test = st["test"]
    return quality_report(spark, train=train, test=test, prepared_train=X.drop(TARGET), prepared_test=Xt,
                          id_col=ID, target_col=TARGET, engineered=add_features(train, SPEC.features),
                          expected_derived=_EXPECTED_DERIVED, board=board, score_col="mean_rmsle", oof=oof,
                          member_test=member_test, predictions=preds, submission=sub)
