"""Blending and selection over long prediction tables.

Predictions travel as (id, experiment, prediction) rows, never as positional
arrays: a blend is a ``groupBy(id)`` (members per id are bounded by the
number of experiments), a stack is a pivot to one column per member plus a
small MLlib ridge.  Scores are aggregates against the transformed target.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import add

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.exprs import c
from plinth.functions.metrics import RMSE, Metric
from plinth.functions.target import clip_nonneg, inverse_target
from plinth.operators.split import FOLD
from plinth.plans import gram
from plinth.plans.models import FitContext, build_estimator
from plinth.session import written_table

EXP, PRED, LABEL = "experiment", "prediction", "label"


def usable_members(oof: DataFrame, test_pred: DataFrame, experiments: list[str]) -> list[str]:
    """Experiments having both out-of-fold and test predictions, in the given order."""
    have_oof = {r[0] for r in oof.select(EXP).distinct().collect()}
    have_test = {r[0] for r in test_pred.select(EXP).distinct().collect()}
    return [e for e in experiments if e in have_oof and e in have_test]


def blend(preds: DataFrame, id_col: str, members: list[str], how: str) -> DataFrame:
    """(id, prediction): ``mean`` or ``median`` of the members' predictions per id.

    A median takes one prediction of a member for each id; two are an error.
    """
    rows = preds.filter(F.col(EXP).isin(members))
    if how == "mean":
        return rows.groupBy(id_col).agg(F.avg(PRED).alias(PRED))
    # one value a member at most, sorted as a short row: an exact percentile would keep a map for each id
    cols = [f"__m{i}" for i in range(len(members))]
    cells = rows.groupBy(id_col).agg(F.count(PRED).alias("__n"), *[x.alias(n) for n, x in zip(cols, _cells(members), strict=True)])
    own = reduce(add, [F.col(x).isNotNull().cast("int") for x in cols])
    cells = cells.select(id_col, "__n", own.alias("__own"), F.sort_array(F.array(*cols)).alias("__v"))   # nulls come first
    at = lambda i: F.get("__v", F.lit(len(cols)) - F.col("__own") + i)
    low, high = at(F.expr("cast((__own - 1) div 2 AS int)")), at(F.expr("cast(__own div 2 AS int)"))
    middle = F.when(low == high, low).otherwise(0.5 * low + 0.5 * high)
    twice = F.raise_error(F.concat(F.lit(f"{id_col}="), F.coalesce(F.col(id_col).cast("string"), F.lit("NULL")), F.lit(" has two predictions of a member")))
    return cells.select(id_col, F.when(F.col("__n") > F.col("__own"), twice).otherwise(middle).alias(PRED))


def _cells(members: list[str]) -> list[Column]:
    """For each member the aggregate that gives its prediction of a group."""
    return [F.first(F.when(F.col(EXP) == m, F.col(PRED)), ignorenulls=True) for m in members]


def wide(preds: DataFrame, id_col: str, members: list[str]) -> DataFrame:
    """One column per member, from one grouping by id."""
    return (preds.filter(F.col(EXP).isin(members)).groupBy(id_col)
            .agg(*[x.alias(m) for m, x in zip(members, _cells(members), strict=True)]))


def pooled_score(pred: DataFrame, truth: DataFrame, id_col: str, metric: Metric = RMSE, transform: str = "none") -> float:
    return pred.join(truth, id_col).agg(metric.of(F.col(LABEL), F.col(PRED), transform)).first()[0]


def stack(oof: DataFrame, test_pred: DataFrame, truth: DataFrame, id_col: str, members: list[str],
          stacker: str = "ridge", params: dict | None = None, seed: int = 42):
    """Meta-model on the member columns; (oof stack predictions, test stack predictions).

    The meta-model is fitted and scored on the same rows (as the original
    run does), so its score is in-sample.
    """
    params = params or {}
    cols = [f"m{i}" for i in range(len(members))]
    # written: the fit, the scores and the predictions each read it
    train_w = written_table(wide(oof, id_col, members).toDF(id_col, *cols).join(truth, id_col), "members")
    test_w = wide(test_pred, id_col, members).toDF(id_col, *cols)
    stats = train_w.agg(F.count(F.lit(1)), F.stddev_pop(LABEL)).first()
    ctx = FitContext(n_rows=stats[0], target_std=stats[1] or 0.0, n_features=len(cols), seed=seed)
    est = build_estimator(stacker, params, ctx, features_col="__meta", label_col=LABEL)
    model = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="__meta"), est]).fit(train_w)
    return (model.transform(train_w).select(id_col, PRED), model.transform(test_w).select(id_col, PRED))


def stack_out_of_fold(oof: DataFrame, truth: DataFrame, id_col: str, members: list[str], stacker: str = "ridge",
                      params: dict | None = None, seed: int = 42) -> DataFrame:
    """(id, fold, prediction) of the meta-model on rows it has not seen: each fold's rows by weights learned
    on the members' predictions of the other folds.

    A linear stacker needs one pass: cross products of each fold, those of the training folds by
    subtraction, and one projection.  Others are fitted fold by fold.  Rows that lack a member's prediction
    have none here; a single fold (a holdout) leaves nothing to learn from and is an error.
    """
    params, cols = params or {}, [f"m{i}" for i in range(len(members))]
    rows = (oof.filter(F.col(EXP).isin(members)).groupBy(id_col, FOLD)
            .agg(*[x.alias(n) for n, x in zip(cols, _cells(members), strict=True)]).join(truth.select(id_col, LABEL), id_col).dropna(subset=[*cols, LABEL]))
    rows = written_table(VectorAssembler(inputCols=cols, outputCol="__meta").transform(rows).select(id_col, FOLD, LABEL, "__meta"), "members")
    folds = sorted(r[0] for r in rows.select(FOLD).distinct().collect())
    if len(folds) < 2:
        raise ValueError(f"a fold-scored stack takes two folds or more, got {folds}")
    if gram.eligible(stacker, params, len(cols)):
        own = gram.moments_by(rows, "__meta", LABEL, len(cols), FOLD)
        total = sum(own.values())
        fitted = {f: gram.solve(total - own[f], stacker, params) for f in folds}
        parts = F.create_map(*[x for f in folds for x in (F.lit(f), F.array(*map(F.lit, [fitted[f][0], *fitted[f][1].tolist()])))])
        weights, x = F.element_at(parts, F.col(FOLD)), vector_to_array("__meta")
        score = reduce(add, [weights[i + 1] * x[i] for i in range(len(cols))], weights[0])
        return rows.select(id_col, FOLD, score.alias(PRED))
    scored = []
    for f in folds:
        train = rows.filter(F.col(FOLD) != f)
        n, std = train.agg(F.count(F.lit(1)), F.stddev_pop(LABEL)).first()
        ctx = FitContext(n_rows=n, target_std=std or 0.0, n_features=len(cols), seed=seed)
        model = build_estimator(stacker, params, ctx, features_col="__meta", label_col=LABEL).fit(train)
        scored.append(model.transform(rows.filter(F.col(FOLD) == f)).select(id_col, FOLD, PRED))
    return reduce(DataFrame.unionByName, scored)


def _best_first(metric: Metric) -> list:
    """The order of a leaderboard: the metric's better end first, then by name; no number comes last."""
    score = F.nullif(F.col("primary_score"), F.lit(float("nan")))
    return [score.desc_nulls_last() if metric.larger_is_better else score.asc_nulls_last(), F.col("experiment_name")]


def leaderboard(spark: SparkSession, results: list, n_splits: list[int], metric: Metric = RMSE) -> DataFrame:
    """One row per experiment, best first; params as sorted-key JSON."""
    rows = []
    for r in results:
        row = [r.experiment_name, r.model_name, float(r.primary_score), json.dumps(r.params, sort_keys=True),
               r.score_kind]
        row += [None if r.fold_scores.get(k) is None else float(r.fold_scores[k]) for k in n_splits]
        rows.append(tuple(row))
    schema = ("experiment_name string, model_name string, primary_score double, params string, score_kind string"
              + "".join(f", {metric.name}_{k}_folds double" for k in n_splits))
    return spark.createDataFrame(rows, schema).orderBy(*_best_first(metric))


def best(board: DataFrame, metric: Metric = RMSE) -> DataFrame:
    return board.orderBy(*_best_first(metric)).limit(1)


def choose_stack_or_single(stack_score: float, single_scores: dict[str, float], metric: Metric = RMSE) -> tuple[str, float]:
    """Stacking wins ties against the best single model."""
    name, score = min(single_scores.items(), key=lambda kv: (metric.order(kv[1]), kv[0]))
    return ("stacking", stack_score) if metric.order(stack_score) <= metric.order(score) else (name, score)


def submission(test_pred: DataFrame, id_col: str, target_col: str, transform: str) -> DataFrame:
    """(id, target): inverse transform, then clip at 0."""
    return test_pred.select(c(id_col), clip_nonneg(inverse_target(F.col(PRED), transform)).alias(target_col))
