"""Folds: disjoint, covering, per-label sizes within one, stable across partitionings; leak test."""

from pyspark.sql import functions as F

from plinth.operators.split import assign_folds, holdout_quotas, kfold, stratify_labels


def _frame(spark, n=997):
    return spark.range(n).select(F.col("id"), ((F.col("id") * 7919) % 97).cast("double").alias("y"))


def test_stratified_kfold_properties(spark):
    df = _frame(spark)
    folded = assign_folds(df, "y", "id", 5, 42).toPandas()
    assert len(folded) == 997 and folded["id"].is_unique
    sizes = folded.groupby("fold").size()
    assert sizes.max() - sizes.min() <= 1
    per = folded.groupby(["stratum", "fold"]).size().unstack(fill_value=0)
    assert ((per.max(axis=1) - per.min(axis=1)) <= 1).all()


def test_folds_do_not_depend_on_partitioning(spark):
    a = assign_folds(_frame(spark).repartition(3), "y", "id", 5, 42).select("id", "fold").toPandas()
    b = assign_folds(_frame(spark).repartition(11), "y", "id", 5, 42).select("id", "fold").toPandas()
    assert a.sort_values("id")["fold"].tolist() == b.sort_values("id")["fold"].tolist()


def test_labels_equal_frequency(spark):
    labs = stratify_labels(_frame(spark, 1000), "y", "id", 10).toPandas()
    assert sorted(labs.groupby("stratum").size().tolist()) == [100] * 10


def test_kfold_sizes(spark):
    f = kfold(_frame(spark), "id", 5, 42).toPandas()
    s = f.groupby("fold").size()
    assert s.max() - s.min() <= 1


def test_holdout_quotas_largest_remainder():
    q = holdout_quotas({0: 10, 1: 10, 2: 11}, 0.2)
    assert sum(q.values()) == 7 and max(q.values()) - min(q.values()) <= 1


def test_folds_without_shuffle(spark):
    df = spark.range(13).repartition(5)
    got = {r["id"]: r["fold"] for r in kfold(df, "id", 5, 42, shuffle=False).collect()}
    assert [got[i] for i in range(13)] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 4, 4]
    dealt = assign_folds(_frame(spark), "y", "id", 5, 42, shuffle=False).toPandas()
    for _, part in dealt.sort_values("id").groupby("stratum"):
        steps = part["fold"].diff().dropna() % 5
        assert (steps == 1).all()
