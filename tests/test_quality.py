"""One planted failure for each check of the quality report."""

from pyspark.sql import functions as F

from plinth.operators.quality import quality_report


def frames(spark):
    train = spark.range(6).select("id", (F.col("id") * 1.0).alias("y"), F.lit(1.0).alias("x"))
    test = spark.range(10, 14).select("id", F.lit(2.0).alias("x"))
    pred = test.select("id", F.lit(3.0).alias("prediction"))
    return {"train": train, "test": test, "prepared_train": train.drop("y"), "prepared_test": test, "engineered": train.withColumn("age", F.lit(1)),
            "expected_derived": ["age"], "board": spark.createDataFrame([("a", 0.5)], "n string, s double"),
            "oof": train.select("id", F.lit(1.0).alias("prediction")), "member_test": pred, "predictions": pred,
            "submission": pred.toDF("id", "y")}


def report(spark, **changed):
    rows = quality_report(spark, id_col="id", target_col="y", score_col="s", **{**frames(spark), **changed}).collect()
    return {r.check_name for r in rows if not r.ok}


def test_each_check_fails_on_its_own_fault(spark):
    f = frames(spark)
    nan = F.lit(float("nan"))
    assert report(spark) == set()
    assert report(spark, expected_derived=[], engineered=f["train"]) == set()            # nothing was asked for
    assert "required_columns" in report(spark, train=f["train"].drop("y"))
    assert "train_rows_kept" in report(spark, prepared_train=f["prepared_train"].limit(5))
    assert "test_rows_kept" in report(spark, prepared_test=f["prepared_test"].limit(3))
    assert report(spark, prepared_test=f["prepared_test"].withColumn("more", F.lit(1))) == {"same_width"}
    assert report(spark, prepared_test=f["prepared_test"].withColumn("x", nan)) == {"no_missing_after_prep"}
    assert report(spark, engineered=f["train"]) == {"derived_columns_present"}
    assert report(spark, board=f["board"].withColumn("s", nan)) == {"leaderboard_finite"}
    assert report(spark, oof=f["oof"].filter("id > 0")) == {"oof_covers_train"}
    # as many ids as the test table, one of them another's
    moved = f["member_test"].withColumn("id", F.when(F.col("id") == 10, 99).otherwise(F.col("id")))
    assert report(spark, member_test=moved) == {"member_test_covers_test"}
    assert report(spark, predictions=f["predictions"].withColumn("prediction", F.lit(-1.0))) == {"predictions_finite_nonneg"}
    assert report(spark, submission=f["submission"].select("y", "id")) == {"submission_shape"}
