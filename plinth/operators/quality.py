"""Data-quality checks of a finished run: one row per check (check_name, ok, value).

Every check is an aggregate or a schema test; nothing is collected but the
counts themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.exprs import c


def _finite(col) -> F.Column:
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) != float("inf"))


def missing_cells(df: DataFrame) -> int:
    types = dict(df.dtypes)
    exprs = [F.count_if(c(x).isNull() | (F.isnan(c(x)) if types[x] in ("double", "float") else F.lit(False)))
             for x in df.columns]
    return int(sum(df.agg(*exprs).first())) if exprs else 0


def quality_report(spark: SparkSession, *, train: DataFrame, test: DataFrame, prepared_train: DataFrame,
                   prepared_test: DataFrame, id_col: str, target_col: str, engineered: DataFrame,
                   expected_derived: list[str], board: DataFrame, score_col: str, oof: DataFrame,
                   member_test: DataFrame, predictions: DataFrame, submission: DataFrame) -> DataFrame:
    rows = []
    req = int(target_col in train.columns) + int(id_col in test.columns)
    rows.append(("required_columns", req == 2, req))
    n_train, n_test = train.count(), test.count()
    rows.append(("train_rows_kept", prepared_train.count() == n_train, n_train))
    rows.append(("test_rows_kept", prepared_test.count() == n_test, n_test))
    w_tr = len([x for x in prepared_train.columns if x not in (id_col, target_col)])
    w_te = len([x for x in prepared_test.columns if x not in (id_col, target_col)])
    rows.append(("same_width", w_tr == w_te, w_tr))
    miss = missing_cells(prepared_train) + missing_cells(prepared_test)
    rows.append(("no_missing_after_prep", miss == 0, miss))
    present = sum(1 for x in expected_derived if x in engineered.columns)
    rows.append(("derived_columns_present", present > 0 or not expected_derived, present))
    lb = board.agg(F.count(F.lit(1)), F.count_if(_finite(F.col(score_col)))).first()
    rows.append(("leaderboard_finite", lb[0] > 0 and lb[0] == lb[1], lb[0]))
    o = oof.agg(F.count_distinct(c(id_col)), F.count_if(~_finite(F.col("prediction")))).first()
    rows.append(("oof_covers_train", o[0] == n_train and o[1] == 0, o[0]))
    ids = test.select(c(id_col))
    lost = ids.join(member_test.select(c(id_col)).distinct(), id_col, "left_anti").count()
    strange = member_test.select(c(id_col)).join(ids, id_col, "left_anti").limit(1).count()
    rows.append(("member_test_covers_test", lost == 0 and strange == 0, n_test - lost))
    p = predictions.agg(F.count(F.lit(1)), F.count_if(_finite(F.col("prediction")) & (F.col("prediction") >= 0))).first()
    rows.append(("predictions_finite_nonneg", p[0] == n_test and p[1] == p[0], p[1]))
    s_rows = submission.count()
    rows.append(("submission_shape", submission.columns == [id_col, target_col] and s_rows == n_test, s_rows))
    return spark.createDataFrame([(a, bool(b), int(v)) for a, b, v in rows], "check_name string, ok boolean, value long")
