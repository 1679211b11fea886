"""Profiling: numeric/categorical summaries, missing counts, target histogram,
feature-target correlations and the feature/target pairs behind scatter plots.

Each statistic family is one aggregate over all columns; quartiles are exact
(see ``operators.quantile``).  Outputs are DataFrames in long form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.exprs import c, nan_to_null
from plinth.operators.quantile import COLUMN, PROB, VALUE, quantiles


def _explode_structs(one_row: DataFrame, structs: list) -> DataFrame:
    return one_row.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def numeric_summary(df: DataFrame, cols: list[str], exact: bool = True) -> DataFrame:
    """(column, count, mean, std, min, q25, q50, q75, max); std is the sample std."""
    aggs = []
    for i, x in enumerate(cols):
        v = nan_to_null(c(x).cast("double"))
        aggs += [F.count(v).alias(f"n{i}"), F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}"),
                 F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
    one = df.agg(*aggs)
    long = _explode_structs(one, [F.struct(F.lit(x).alias(COLUMN), F.col(f"n{i}").cast("long").alias("count"),
                                           F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("std"),
                                           F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
                                  for i, x in enumerate(cols)])
    q = (quantiles(df, cols, [0.25, 0.5, 0.75], exact=exact)
         .groupBy(COLUMN).agg(*[F.max(F.when(F.col(PROB) == p, F.col(VALUE))).alias(name)
                                for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]))
    return long.join(q, COLUMN, "left").select(COLUMN, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def categorical_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, count, unique, top, freq); ties for ``top`` go to the smallest value."""
    cells = F.explode(F.array(*[F.struct(F.lit(x).alias(COLUMN), c(x).cast("string").alias(VALUE)) for x in cols]))
    long = df.select(cells.alias("cell")).select("cell.*").filter(F.col(VALUE).isNotNull())
    counts = long.groupBy(COLUMN, VALUE).agg(F.count(F.lit(1)).alias("cnt"))
    return counts.groupBy(COLUMN).agg(
        F.sum("cnt").cast("long").alias("count"), F.count(F.lit(1)).cast("long").alias("unique"),
        F.min_by(VALUE, F.struct(-F.col("cnt"), F.col(VALUE))).alias("top"), F.max("cnt").cast("long").alias("freq"))


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, missing_count) for columns with at least one missing cell."""
    cols = cols or df.columns
    types = dict(df.dtypes)
    aggs = [F.count_if((nan_to_null(c(x)) if types[x] in ("double", "float") else c(x)).isNull()).alias(f"m{i}")
            for i, x in enumerate(cols)]
    long = _explode_structs(df.agg(*aggs), [F.struct(F.lit(x).alias(COLUMN),
                                                     F.col(f"m{i}").cast("long").alias("missing_count"))
                                            for i, x in enumerate(cols)])
    return long.filter(F.col("missing_count") > 0)


def missing_top_k(df: DataFrame, k: int, cols: list[str] | None = None) -> DataFrame:
    return missing_counts(df, cols).orderBy(F.desc("missing_count"), F.asc(COLUMN)).limit(k)


def target_histogram(df: DataFrame, target: str, bins: int = 40) -> DataFrame:
    """(bin, lo, hi, count) for ``bins`` equal bins over [min, max]; the last bin is closed."""
    y = nan_to_null(c(target).cast("double"))
    lo, hi = df.agg(F.min(y), F.max(y)).first()          # two scalars
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, lo double, hi double, count long")
    width = hi - lo
    bucket = (F.lit(1) if width == 0 else
              F.least(F.floor((y - F.lit(lo)) * bins / F.lit(width)).cast("int") + 1, F.lit(bins)))
    counted = (df.filter(y.isNotNull()).groupBy(bucket.alias("bin"))
               .agg(F.count(F.lit(1)).cast("long").alias("count")))
    b = F.col("bin")
    edges = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin")).select(
        "bin", (F.lit(lo) + (b - 1) * F.lit(width) / bins).alias("lo"), (F.lit(lo) + b * F.lit(width) / bins).alias("hi"))
    return edges.join(counted, "bin", "left").select("bin", "lo", "hi", F.coalesce("count", F.lit(0)).alias("count"))


def pearson(a, b):
    """|pearson| on rows where both are present; NULL (not an error) for zero variance."""
    both_a, both_b = F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)
    return F.try_divide(F.covar_samp(a, b), F.sqrt(F.var_samp(both_a) * F.var_samp(both_b)))


def target_correlations(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """(column, abs_corr) of every numeric column with the target."""
    y = nan_to_null(c(target).cast("double"))
    aggs = [F.abs(pearson(nan_to_null(c(x).cast("double")), y)).alias(f"r{i}") for i, x in enumerate(cols)]
    return _explode_structs(df.agg(*aggs), [F.struct(F.lit(x).alias(COLUMN), F.col(f"r{i}").alias("abs_corr"))
                                            for i, x in enumerate(cols)])


def top_target_correlations(df: DataFrame, target: str, cols: list[str], k: int) -> DataFrame:
    return (target_correlations(df, target, cols)
            .orderBy(F.desc_nulls_last("abs_corr"), F.asc(COLUMN)).limit(k))


def feature_target_pairs(df: DataFrame, id_col: str, target: str, features: list[str]) -> DataFrame:
    """(id, feature, x, y) for every row and every chosen feature: the scatter data, whole."""
    cells = F.explode(F.array(*[F.struct(F.lit(x).alias("feature"), c(x).cast("double").alias("x"))
                                for x in features]))
    return df.select(c(id_col).alias(id_col), c(target).cast("double").alias("y"), cells.alias("cell")).select(
        id_col, "cell.feature", "cell.x", "y")
