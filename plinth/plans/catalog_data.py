"""Registered queries for scans, sinks, profiling, features, cleaning, prep, target
transforms, splits and unions, each with an equivalent DuckDB SQL text.

All queries run on the ``fx`` table derived from the given parquet tables
(train = ``id % 5 <> 0``, test = the rest) over whole tables.  Floating
outputs are rounded to 6 digits on both sides.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.ml.functions import vector_to_array

from plinth.functions.exprs import c
from plinth.functions.target import clip_nonneg, inverse_target, transform_target
from plinth.operators import profile
from plinth.operators.clean import constant_columns, fit_cleaner
from plinth.operators.features import add_features, derived_columns, feature_types
from plinth.operators.prep import (ClipModel, ImputeModel, fit_categorical_fill, fit_clip_bounds, fit_numeric_fill,
                                   fit_scaler, onehot_stages)
from plinth.operators.quantile import COLUMN, fold_quantiles
from plinth.operators.rank import global_rank
from plinth.operators.split import FOLD, LABEL, assign_folds, kfold, stratify_labels
from plinth.operators.correlate import pair_correlations
from plinth.operators.stats import distinct_counts, fold_moments
from plinth.session import work_path, written_table
from plinth.sources.csv import scan_csv, write_csv
from plinth.sources.fixture import FX_SQL, ID, TARGET, train_test
from plinth.spec import fixture_spec

SPEC = fixture_spec()
FE = SPEC.features
SEED = SPEC.seed

# fx column roles (fixed by the fixture definition)
NUMERIC_RAW = ["yr_sold", "mo_sold", "year_built", "year_remod", "area_bsmt", "area_1st", "area_2nd", "area_living",
               "area_garage", "full_bath", "half_bath", "bsmt_full_bath", "bsmt_half_bath", "overall_qual",
               "garage_cars", "area_living_copy"]
CATEGORICAL = ["zoning", "street", "neighborhood", "alley", "utilities"]
ALL_RAW = [ID, TARGET, "yr_sold", "mo_sold", "year_built", "year_remod", "area_bsmt", "area_1st", "area_2nd",
           "area_living", "area_garage", "full_bath", "half_bath", "bsmt_full_bath", "bsmt_half_bath", "overall_qual",
           "garage_cars", "zoning", "street", "neighborhood", "alley", "utilities", "area_living_copy"]

# derived columns as SQL (same arithmetic order as the Spark expressions)
DERIVED_SQL = {
    "sale_month_index": "yr_sold * 12 + mo_sold",
    "years_since_sale_2010": "2010 - yr_sold",
    "total_usable_area": "CAST(coalesce(area_bsmt, 0.0::DOUBLE) + coalesce(area_1st, 0.0::DOUBLE) + "
                         "coalesce(area_2nd, 0.0::DOUBLE) + coalesce(area_living, 0.0::DOUBLE) + "
                         "coalesce(area_garage, 0.0::DOUBLE) AS DOUBLE)",
    "total_bathrooms": "coalesce(full_bath, 0.0::DOUBLE) * 1.0::DOUBLE + coalesce(half_bath, 0.0::DOUBLE) * 0.5::DOUBLE"
                       " + coalesce(bsmt_full_bath, 0.0::DOUBLE) * 1.0::DOUBLE"
                       " + coalesce(bsmt_half_bath, 0.0::DOUBLE) * 0.5::DOUBLE",
    "house_age_at_sale": "yr_sold - year_built",
    "years_since_remodel": "yr_sold - year_remod",
    "overall_qual_x_area_living": "coalesce(overall_qual, 0.0::DOUBLE) * coalesce(area_living, 0.0::DOUBLE)",
    "garage_cars_x_area_garage": "coalesce(garage_cars, 0.0::DOUBLE) * coalesce(area_garage, 0.0::DOUBLE)",
    "area_bsmt_x_area_1st": "coalesce(area_bsmt, 0.0::DOUBLE) * coalesce(area_1st, 0.0::DOUBLE)",
}
DERIVED = list(DERIVED_SQL)
NUMERIC_FE = NUMERIC_RAW + DERIVED
FE_FEATURES = [x for x in ALL_RAW if x not in (ID, TARGET)] + DERIVED
NUMERIC_FE_ORDERED = [x for x in FE_FEATURES if x not in CATEGORICAL]

FE_CTE = (", train_fe AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in DERIVED_SQL.items()) + " FROM train)"
          ", test_fe AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in DERIVED_SQL.items()) + " FROM test)")


def sql(body: str) -> str:
    # "column" is a keyword in DuckDB: quote it where it is an identifier
    body = re.sub(r"(?<!['\"])\bcolumn\b(?!['\"])", '"column"', body)
    return FX_SQL + FE_CTE + "\n" + body


def r6(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (both sides round before comparing)."""
    return df.select([F.round(c(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                      else c(f.name) for f in df.schema.fields])


def unnest_sql(rows: list[dict], source: str) -> str:
    """One aggregate row -> long rows: SELECT unnest([{...}, ...], recursive := true) FROM (source)."""
    items = ", ".join("{" + ", ".join(f"'{k}': {v}" for k, v in row.items()) + "}" for row in rows)
    return f"SELECT unnest([{items}], recursive := true) FROM ({source}) agg"


def _tt(spark: SparkSession, sf: str):
    return train_test(spark, sf)


def _fe(spark: SparkSession, sf: str):
    train, test = _tt(spark, sf)
    return add_features(train, FE), add_features(test, FE)


Q: dict = {}
O: dict = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        Q[key] = fn
        if oracle is not None:
            O[key] = oracle
        return fn
    return deco

# ------------------------------------------------------------------ S: scans and sinks


@register("scan_csv_na", sql("SELECT id, area_bsmt, alley, CAST(full_bath AS BIGINT) AS full_bath, zoning FROM train"))
def scan_csv_na(spark, sf):
    """Write train with 'NA' for gaps, scan back with pandas-style tokens and inferred types."""
    train, _ = _tt(spark, sf)
    path = work_path(spark, "csv_na")
    write_csv(train.select(ID, "area_bsmt", "alley", "full_bath", "zoning"), path, na_token="NA")
    return scan_csv(spark, path)


@register("project_features", sql("SELECT * EXCLUDE (sale_price) FROM train"))
def project_features(spark, sf):
    train, _ = _tt(spark, sf)
    return train.drop(TARGET)


@register("sink_csv_roundtrip", sql("SELECT id, sale_price FROM train"))
def sink_csv_roundtrip(spark, sf):
    train, _ = _tt(spark, sf)
    path = work_path(spark, "csv_sink")
    write_csv(train.select(ID, TARGET), path)
    schema = T.StructType([T.StructField(ID, T.LongType()), T.StructField(TARGET, T.DoubleType())])
    return scan_csv(spark, path, schema)


@register("preview_head", sql("SELECT * FROM train ORDER BY id LIMIT 5"))
def preview_head(spark, sf):
    train, _ = _tt(spark, sf)
    return train.orderBy(ID).limit(5)

# ------------------------------------------------------------------ P: profiling


_NUM_PROFILE = [ID, TARGET] + NUMERIC_RAW


def _num_profile_sql() -> str:
    rows = [{"column": f"'{x}'", "count": f"n_{i}", "mean": f"round(m_{i}, 6)", "std": f"round(s_{i}, 6)",
             "min": f"round(lo_{i}, 6)", "q25": f"round(a_{i}, 6)", "q50": f"round(b_{i}, 6)",
             "q75": f"round(d_{i}, 6)", "max": f"round(hi_{i}, 6)"} for i, x in enumerate(_NUM_PROFILE)]
    aggs = ", ".join(
        f"count({x}) AS n_{i}, avg({x}::DOUBLE) AS m_{i}, stddev_samp({x}::DOUBLE) AS s_{i}, min({x}::DOUBLE) AS lo_{i},"
        f" max({x}::DOUBLE) AS hi_{i}, quantile_cont({x}::DOUBLE, 0.25) AS a_{i}, quantile_cont({x}::DOUBLE, 0.5) AS b_{i},"
        f" quantile_cont({x}::DOUBLE, 0.75) AS d_{i}" for i, x in enumerate(_NUM_PROFILE))
    return sql(unnest_sql(rows, f"SELECT {aggs} FROM train"))


@register("profile_numeric", _num_profile_sql())
def profile_numeric(spark, sf):
    train, _ = _tt(spark, sf)
    return r6(profile.numeric_summary(train, _NUM_PROFILE))


def _cat_long_sql(source: str, cols: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{x}' AS column, CAST({x} AS VARCHAR) AS value FROM {source}" for x in cols)


@register("profile_categorical", sql(f"""
SELECT column, CAST(sum(cnt) AS BIGINT) AS count, CAST(count(*) AS BIGINT) AS unique,
       first(value ORDER BY cnt DESC, value) AS top, CAST(max(cnt) AS BIGINT) AS freq
FROM (SELECT column, value, count(*) AS cnt FROM ({_cat_long_sql('train', CATEGORICAL)}) WHERE value IS NOT NULL
      GROUP BY column, value) GROUP BY column"""))
def profile_categorical(spark, sf):
    train, _ = _tt(spark, sf)
    return profile.categorical_summary(train, CATEGORICAL)


def _missing_sql(cols: list[str]) -> str:
    rows = [{"column": f"'{x}'", "missing_count": f"m_{i}"} for i, x in enumerate(cols)]
    src = "SELECT " + ", ".join(f"CAST(count(*) - count({x}) AS BIGINT) AS m_{i}" for i, x in enumerate(cols)) + \
          " FROM train"
    return unnest_sql(rows, src)


@register("profile_missing", sql(f"SELECT * FROM ({_missing_sql(ALL_RAW)}) WHERE missing_count > 0"))
def profile_missing(spark, sf):
    train, _ = _tt(spark, sf)
    return profile.missing_counts(train)


@register("profile_missing_topk", sql(f"SELECT * FROM ({_missing_sql(ALL_RAW)}) WHERE missing_count > 0 "
                                      f"ORDER BY missing_count DESC, column LIMIT 20"))
def profile_missing_topk(spark, sf):
    train, _ = _tt(spark, sf)
    return profile.missing_top_k(train, SPEC.profile.missing_top_k)


@register("profile_target_hist", sql("""
, mm AS (SELECT min(sale_price) AS lo, max(sale_price) AS hi FROM train),
cnt AS (SELECT least(CAST(floor((sale_price - lo) * 40 / (hi - lo)) AS INTEGER) + 1, 40) AS bin, count(*) AS c
        FROM train, mm WHERE sale_price IS NOT NULL GROUP BY 1)
SELECT CAST(b.range AS INTEGER) AS bin, round(lo + (b.range - 1) * (hi - lo) / 40, 6) AS lo,
       round(lo + b.range * (hi - lo) / 40, 6) AS hi, CAST(coalesce(cnt.c, 0) AS BIGINT) AS count
FROM range(1, 41) b CROSS JOIN mm LEFT JOIN cnt ON cnt.bin = b.range"""))
def profile_target_hist(spark, sf):
    train, _ = _tt(spark, sf)
    return r6(profile.target_histogram(train, TARGET, SPEC.profile.hist_bins))


_CORR_FEATURES = [ID] + NUMERIC_RAW


def _pearson_sql(a: str, b: str) -> str:
    return (f"abs(covar_samp({a}, {b}) / nullif(sqrt(var_samp(CASE WHEN {b} IS NOT NULL THEN {a} END) * "
            f"var_samp(CASE WHEN {a} IS NOT NULL THEN {b} END)), 0))")


def _target_corr_sql() -> str:
    rows = [{"column": f"'{x}'", "abs_corr": f"round(r_{i}, 6)"} for i, x in enumerate(_CORR_FEATURES)]
    src = "SELECT " + ", ".join(f"{_pearson_sql(f'{x}::DOUBLE', 'sale_price')} AS r_{i}"
                                for i, x in enumerate(_CORR_FEATURES)) + " FROM train"
    return unnest_sql(rows, src)


@register("profile_target_corr", sql(f"SELECT * FROM ({_target_corr_sql()}) "
                                     f"ORDER BY abs_corr DESC NULLS LAST, column LIMIT 15"))
def profile_target_corr(spark, sf):
    train, _ = _tt(spark, sf)
    return r6(profile.top_target_correlations(train, TARGET, _CORR_FEATURES, SPEC.profile.top_numeric_features))


@register("profile_pairs", sql(f"""
, top AS (SELECT column FROM ({_target_corr_sql()}) ORDER BY abs_corr DESC NULLS LAST, column LIMIT 15)
SELECT p.* FROM ({' UNION ALL '.join(f"SELECT id, '{x}' AS feature, CAST({x} AS DOUBLE) AS x, sale_price AS y FROM train"
                                      for x in _CORR_FEATURES)}) p JOIN top ON p.feature = top.column"""))
def profile_pairs(spark, sf):
    """All (id, feature, x, y) of the top-15 correlated features: the whole scatter data."""
    train, _ = _tt(spark, sf)
    top = [r[COLUMN] for r in profile.top_target_correlations(train, TARGET, _CORR_FEATURES,
                                                              SPEC.profile.top_numeric_features).collect()]
    return profile.feature_target_pairs(train, ID, TARGET, top)

# ------------------------------------------------------------------ F: features


def _fe_one(name: str):
    def q(spark, sf):
        train, _ = _tt(spark, sf)
        return r6(train.select(ID, derived_columns(FE, train.columns)[name].alias(name)))
    return q


for _key, _name in (("fe_month_index", "sale_month_index"), ("fe_years_since", "years_since_sale_2010"),
                    ("fe_total_area", "total_usable_area"), ("fe_total_bath", "total_bathrooms"),
                    ("fe_age", "house_age_at_sale"), ("fe_years_remodel", "years_since_remodel")):
    register(_key, sql(f"SELECT id, {'round(' + DERIVED_SQL[_name] + ', 6)' if _name in ('total_usable_area', 'total_bathrooms') else DERIVED_SQL[_name]} AS {_name} FROM train"))(_fe_one(_name))

register("fe_interactions", sql("SELECT id, " + ", ".join(
    f"round({DERIVED_SQL[n]}, 6) AS {n}" for n in DERIVED if "_x_" in n) + " FROM train"))(
    lambda spark, sf: r6(add_features(_tt(spark, sf)[0], FE).select(ID, *[n for n in DERIVED if "_x_" in n])))


@register("fe_all", sql("SELECT * FROM train_fe"))
def fe_all(spark, sf):
    train, _ = _tt(spark, sf)
    return r6(add_features(train, FE))


@register("feature_types", sql(" UNION ALL ".join(
    f"SELECT '{x}' AS column, CASE WHEN any_value(typeof({x})) IN ('TINYINT','SMALLINT','INTEGER','BIGINT','FLOAT','DOUBLE') "
    f"OR any_value(typeof({x})) LIKE 'DECIMAL%' THEN 'numeric' ELSE 'categorical' END AS kind, count({x}) AS n_values FROM train_fe"
    for x in FE_FEATURES)))
def feature_types_q(spark, sf):
    """Each feature's kind, with the number of values it has in the table."""
    train, _ = _fe(spark, sf)
    num, cat = feature_types(train, exclude=(ID, TARGET))
    kinds = [(x, "numeric") for x in num] + [(x, "categorical") for x in cat]
    one = train.agg(*[F.count(c(x)).alias(x) for x, _ in kinds])
    rows = F.array(*[F.struct(F.lit(x).alias("column"), F.lit(k).alias("kind"), c(x).alias("n_values")) for x, k in kinds])
    return one.select(F.explode(rows).alias("r")).select("r.*")

# ------------------------------------------------------------------ C: cleaning and clipping


def _nunique_sql() -> str:
    rows = [{"column": f"'{x}'", "nunique": f"u_{i}"} for i, x in enumerate(FE_FEATURES)]
    src = "SELECT " + ", ".join(f"CAST(count(DISTINCT {x}) + CASE WHEN count(*) > count({x}) THEN 1 ELSE 0 END AS BIGINT)"
                                f" AS u_{i}" for i, x in enumerate(FE_FEATURES)) + " FROM train_fe"
    return unnest_sql(rows, src)


@register("clean_nunique", sql(_nunique_sql()))
def clean_nunique(spark, sf):
    train, _ = _fe(spark, sf)
    counts = distinct_counts(train, FE_FEATURES)[None]
    return spark.createDataFrame([(x, int(counts[x])) for x in FE_FEATURES], "column string, nunique long")


@register("clean_constant", sql(f"SELECT column FROM ({_nunique_sql()}) WHERE nunique <= 1"))
def clean_constant(spark, sf):
    train, _ = _fe(spark, sf)
    return spark.createDataFrame([(x,) for x in constant_columns(train, FE_FEATURES, 1)[None]], "column string")


_CORR_COLS = [x for x in NUMERIC_FE_ORDERED]    # no numeric column of fx is constant


def _pairs_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]
    rows = [{"left": f"'{a}'", "right": f"'{b}'", "abs_corr": f"r_{j}"} for j, (a, b) in enumerate(pairs)]
    src = "SELECT " + ", ".join(f"{_pearson_sql(f'{a}::DOUBLE', f'{b}::DOUBLE')} AS r_{j}"
                                for j, (a, b) in enumerate(pairs)) + " FROM train_fe"
    return unnest_sql(rows, src)


@register("clean_corr_pairs", sql(f"SELECT \"left\", \"right\", round(abs_corr, 6) AS abs_corr FROM ({_pairs_sql()})"))
def clean_corr_pairs(spark, sf):
    train, _ = _fe(spark, sf)
    corr = pair_correlations(train, _CORR_COLS)[None]
    rows = [(a, b, v) for (a, b), v in corr.items()]
    return r6(spark.createDataFrame(rows, "left string, right string, abs_corr double"))


@register("clean_correlated", sql(f"SELECT DISTINCT \"right\" AS column FROM ({_pairs_sql()}) "
                                  f"WHERE round(abs_corr, 12) > 0.995"))
def clean_correlated(spark, sf):
    train, _ = _fe(spark, sf)
    drops = fit_cleaner(train, _CORR_COLS, drop_constant=False, drop_correlated=True,
                        correlation_threshold=SPEC.prep.correlation_threshold)[None]
    return spark.createDataFrame([(x,) for x in drops], "column string")


# the columns the cleaner finds on fx (checked by clean_constant / clean_correlated)
_CLEAN_DROP = ["area_living_copy", "utilities", "years_since_sale_2010"]


@register("clean_transform", sql(f"SELECT * EXCLUDE ({', '.join(_CLEAN_DROP)}) FROM test_fe"))
def clean_transform(spark, sf):
    train, test = _fe(spark, sf)
    drop = fit_cleaner(train, FE_FEATURES)[None]
    return r6(test.drop(*drop))


def _bounds_sql(cols: list[str], lo: float, hi: float) -> str:
    return "SELECT " + ", ".join(f"quantile_cont({x}::DOUBLE, {lo}) AS lo_{i}, quantile_cont({x}::DOUBLE, {hi}) AS hi_{i}"
                                 for i, x in enumerate(cols)) + " FROM train_fe"


@register("clip_bounds", sql(unnest_sql([{"column": f"'{x}'", "lower": f"round(lo_{i}, 6)", "upper": f"round(hi_{i}, 6)"}
                                         for i, x in enumerate(NUMERIC_FE_ORDERED)], _bounds_sql(NUMERIC_FE_ORDERED, 0.01, 0.99))))
def clip_bounds(spark, sf):
    train, _ = _fe(spark, sf)
    b = fit_clip_bounds(train, NUMERIC_FE_ORDERED, 0.01, 0.99)[None]
    return r6(spark.createDataFrame([(x, b[x][0], b[x][1]) for x in NUMERIC_FE_ORDERED],
                                    "column string, lower double, upper double"))


@register("clip_transform", sql(f", b AS ({_bounds_sql(NUMERIC_FE_ORDERED, 0.01, 0.99)}) SELECT id, " + ", ".join(
    f"round(CASE WHEN {x} IS NULL THEN NULL ELSE least(greatest({x}::DOUBLE, lo_{i}), hi_{i}) END, 6) AS {x}"
    for i, x in enumerate(NUMERIC_FE_ORDERED)) + " FROM test_fe, b"))
def clip_transform(spark, sf):
    train, test = _fe(spark, sf)
    b = fit_clip_bounds(train, NUMERIC_FE_ORDERED, 0.01, 0.99)[None]
    return r6(ClipModel.of(bounds=b).transform(test.select(ID, *NUMERIC_FE_ORDERED)))

# ------------------------------------------------------------------ I / N / O: imputation, scaling, encoding


def _stat_sql(fn: str, source: str = "train_fe", cols: list[str] = NUMERIC_FE_ORDERED) -> str:
    rows = [{"column": f"'{x}'", "value": f"round(v_{i}, 6)"} for i, x in enumerate(cols)]
    return unnest_sql(rows, "SELECT " + ", ".join(f"{fn.format(x=f'{x}::DOUBLE')} AS v_{i}" for i, x in enumerate(cols))
                      + f" FROM {source}")


def _fills_df(spark, fills: dict) -> DataFrame:
    return r6(spark.createDataFrame([(x, None if v is None else float(v)) for x, v in fills.items()],
                                    "column string, value double"))


@register("impute_median", sql(_stat_sql("median({x})")))
def impute_median(spark, sf):
    train, _ = _fe(spark, sf)
    return _fills_df(spark, fit_numeric_fill(train, NUMERIC_FE_ORDERED, "median")[None])


@register("impute_mean", sql(_stat_sql("avg({x})")))
def impute_mean(spark, sf):
    train, _ = _fe(spark, sf)
    return _fills_df(spark, fit_numeric_fill(train, NUMERIC_FE_ORDERED, "mean")[None])


@register("impute_joint", sql(_stat_sql("median({x})", "(SELECT * EXCLUDE (sale_price) FROM train_fe "
                                                       "UNION ALL SELECT * FROM test_fe)")))
def impute_joint(spark, sf):
    """Medians over train + test together (opt-in: it uses test statistics)."""
    train, test = _fe(spark, sf)
    both = train.drop(TARGET).unionByName(test)
    return _fills_df(spark, fit_numeric_fill(both, NUMERIC_FE_ORDERED, "median")[None])


@register("impute_mode", sql(f"""
SELECT column, first(value ORDER BY cnt DESC, value) AS value
FROM (SELECT column, value, count(*) AS cnt FROM ({_cat_long_sql('train_fe', CATEGORICAL)}) WHERE value IS NOT NULL
      GROUP BY column, value) GROUP BY column"""))
def impute_mode(spark, sf):
    train, _ = _fe(spark, sf)
    fills = fit_categorical_fill(train, CATEGORICAL, "most_frequent")[None]
    return spark.createDataFrame(list(fills.items()), "column string, value string")


@register("impute_token", sql("SELECT id, " + ", ".join(f"coalesce({x}, 'Missing') AS {x}" for x in CATEGORICAL)
                              + " FROM test_fe"))
def impute_token(spark, sf):
    _, test = _fe(spark, sf)
    return test.select(ID, *CATEGORICAL).fillna(SPEC.prep.missing_token, subset=CATEGORICAL)


@register("impute_train_to_test", sql(f", m AS ({'SELECT ' + ', '.join(f'median({x}::DOUBLE) AS v_{i}' for i, x in enumerate(NUMERIC_FE_ORDERED)) + ' FROM train_fe'}) "
                                      "SELECT id, " + ", ".join(f"round(coalesce({x}::DOUBLE, v_{i}), 6) AS {x}"
                                                                for i, x in enumerate(NUMERIC_FE_ORDERED))
                                      + " FROM test_fe, m"))
def impute_train_to_test(spark, sf):
    train, test = _fe(spark, sf)
    fills = fit_numeric_fill(train, NUMERIC_FE_ORDERED, "median")[None]
    return r6(ImputeModel.of(numeric=fills, categorical={}).transform(test.select(ID, *NUMERIC_FE_ORDERED)))


@register("scale_standard", sql(f", s AS ({'SELECT ' + ', '.join(f'avg({x}::DOUBLE) AS mu_{i}, stddev_pop({x}::DOUBLE) AS sd_{i}' for i, x in enumerate(NUMERIC_FE_ORDERED)) + ' FROM train_fe'}) "
                                "SELECT id, " + ", ".join(
                                    f"round(({x}::DOUBLE - mu_{i}) / CASE WHEN sd_{i} > 0 THEN sd_{i} ELSE 1 END, 6) AS {x}"
                                    for i, x in enumerate(NUMERIC_FE_ORDERED)) + " FROM test_fe, s"))
def scale_standard(spark, sf):
    """Standardise with train mean and population std (missing stays missing)."""
    from plinth.operators.prep import ScaleModel
    train, test = _fe(spark, sf)
    params = fit_scaler(train, NUMERIC_FE_ORDERED)[None]
    return r6(ScaleModel.of(scale=params).transform(test.select(ID, *NUMERIC_FE_ORDERED)))


@register("onehot_fit_transform", sql(f"""
, cats AS (SELECT column, value, CAST(dense_rank() OVER (PARTITION BY column ORDER BY value) - 1 AS INTEGER) AS slot
           FROM (SELECT DISTINCT column, value FROM ({_cat_long_sql('train_fe', CATEGORICAL)}) WHERE value IS NOT NULL)),
t AS ({_cat_long_sql('test_fe', CATEGORICAL).replace("SELECT '", "SELECT id, '")})
SELECT t.id, t.column, coalesce(cats.slot, -1) AS slot
FROM t LEFT JOIN cats ON t.column = cats.column AND t.value = cats.value"""))
def onehot_fit_transform(spark, sf):
    """Categories fitted on train; test rows encoded; slot -1 = all zeros (unknown or missing)."""
    from plinth.operators.categories import categories
    train, test = _fe(spark, sf)
    cats = categories(train, CATEGORICAL)[None]
    stages, oh_cols = onehot_stages(test, cats)
    from pyspark.ml import PipelineModel
    enc = PipelineModel(stages).transform(test.select(ID, *CATEGORICAL))
    cells = F.explode(F.array(*[F.struct(F.lit(x).alias("column"),
                                         (F.array_position(vector_to_array(F.col(f"{x}__oh")), 1.0) - 1)
                                         .cast("int").alias("slot")) for x in CATEGORICAL]))
    return enc.select(c(ID), cells.alias("cell")).select(ID, "cell.column", "cell.slot")


@register("dummies_wide", sql(f"""
, u AS (SELECT * EXCLUDE (sale_price) FROM train_fe UNION ALL SELECT * FROM test_fe),
l AS ({_cat_long_sql('u', CATEGORICAL).replace("SELECT '", "SELECT id, '")}),
f AS (SELECT id, column, coalesce(value, 'Missing') AS value FROM l),
cats AS (SELECT DISTINCT column, value FROM f)
SELECT u.id, cats.column || '_' || cats.value AS dummy,
       CASE WHEN f.value = cats.value THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value
FROM u JOIN cats ON TRUE JOIN f ON f.id = u.id AND f.column = cats.column"""))
def dummies_wide(spark, sf):
    """Wide 0/1 columns for every value of train + test (gaps as 'Missing'), shown in long form."""
    from plinth.operators.prep import dummies
    train, test = _fe(spark, sf)
    both = train.drop(TARGET).unionByName(test)
    wide, names = dummies(both, CATEGORICAL, SPEC.prep.missing_token)
    cells = F.explode(F.array(*[F.struct(F.lit(n).alias("dummy"), c(n).alias("value")) for n in names]))
    return wide.select(c(ID), cells.alias("cell")).select(ID, "cell.dummy", "cell.value")

# ------------------------------------------------------------------ T: target transforms


@register("target_log1p", sql("SELECT id, round(ln(1 + sale_price), 6) AS y_log FROM train"))
def target_log1p(spark, sf):
    train, _ = _tt(spark, sf)
    return r6(train.select(ID, transform_target(c(TARGET), "log1p").alias("y_log")))


@register("target_roundtrip", sql("SELECT id, sale_price AS y, round(exp(ln(1 + sale_price)) - 1, 4) AS y_back FROM train"))
def target_roundtrip(spark, sf):
    train, _ = _tt(spark, sf)
    back = inverse_target(transform_target(c(TARGET), "log1p"), "log1p")
    return train.select(ID, c(TARGET).alias("y"), F.round(back, 4).alias("y_back"))


@register("clip_nonneg", sql("SELECT id, CASE WHEN sale_price IS NULL THEN NULL "
                             "ELSE greatest(sale_price - 200000, 0.0) END AS clipped FROM train"))
def clip_nonneg_q(spark, sf):
    train, _ = _tt(spark, sf)
    return r6(train.select(ID, clip_nonneg(c(TARGET) - 200000).alias("clipped")))

# ------------------------------------------------------------------ W: ranks and splits


def folds_sql(k: int = 5, seed: int = SEED, bins: int = 10, source: str = "train") -> str:
    """CTEs strat(id, stratum) and folds_{k}(id, fold) in SQL (row_number is fine in the oracle)."""
    return f"""
, lab_{k} AS (SELECT id, row_number() OVER (ORDER BY sale_price, id) AS r, count(*) OVER () AS n FROM {source}),
q_{k} AS (SELECT least(greatest(2, {bins}), greatest(2, count(DISTINCT sale_price))) AS q FROM {source}),
strat_{k} AS (SELECT id, CAST(CASE WHEN r = 1 THEN 0 ELSE ((r - 1) * q + n - 2) // (n - 1) - 1 END AS INTEGER) AS stratum
           FROM lab_{k}, q_{k}),
folds_{k} AS (SELECT id, stratum, CAST((row_number() OVER (ORDER BY stratum, md5(concat_ws('|', CAST(id AS VARCHAR), '{seed}')), id) - 1) % {k}
              AS INTEGER) AS fold FROM strat_{k})"""


def kfold_sql(k: int = 5, seed: int = SEED, source: str = "train") -> str:
    return f"""
, kf_{k} AS (SELECT id, CAST((row_number() OVER (ORDER BY md5(concat_ws('|', CAST(id AS VARCHAR), '{seed}')), id) - 1) % {k}
             AS INTEGER) AS fold FROM {source})"""


@register("rank_first", sql("SELECT id, row_number() OVER (ORDER BY sale_price, id) AS rank FROM train"))
def rank_first(spark, sf):
    train, _ = _tt(spark, sf)
    return global_rank(train.select(ID, TARGET), [c(TARGET), c(ID)], "rank").select(ID, "rank")


@register("strat_labels", sql(folds_sql() + " SELECT id, stratum FROM strat_5"))
def strat_labels(spark, sf):
    train, _ = _tt(spark, sf)
    return stratify_labels(train.select(ID, TARGET), TARGET, ID, SPEC.validation.stratify_bins).select(ID, LABEL)


@register("split_strat_kfold", sql(folds_sql() + " SELECT id, fold FROM folds_5"))
def split_strat_kfold(spark, sf):
    train, _ = _tt(spark, sf)
    return assign_folds(train.select(ID, TARGET), TARGET, ID, 5, SEED, SPEC.validation.stratify_bins).select(ID, FOLD)


@register("split_strat_holdout", sql(folds_sql() + """
, cnt AS (SELECT stratum, count(*) AS c FROM strat_5 GROUP BY stratum),
tot AS (SELECT sum(c) AS n, CAST(ceil(0.2 * sum(c)) AS BIGINT) AS nv FROM cnt),
ex AS (SELECT stratum, c * nv / n AS e, floor(c * nv / n) AS fl FROM cnt, tot),
rk AS (SELECT stratum, fl, row_number() OVER (ORDER BY e - fl DESC, stratum) AS rr FROM ex),
quota AS (SELECT stratum, fl + CASE WHEN rr <= (SELECT nv FROM tot) - (SELECT sum(fl) FROM ex) THEN 1 ELSE 0 END AS qv FROM rk),
pos AS (SELECT id, stratum, row_number() OVER (PARTITION BY stratum ORDER BY md5(concat_ws('|', CAST(id AS VARCHAR), '42')), id) AS p
        FROM strat_5)
SELECT id, CAST(CASE WHEN p <= qv THEN 0 ELSE 1 END AS INTEGER) AS fold FROM pos JOIN quota USING (stratum)"""))
def split_strat_holdout(spark, sf):
    train, _ = _tt(spark, sf)
    return assign_folds(train.select(ID, TARGET), TARGET, ID, 1, SEED, SPEC.validation.stratify_bins,
                        SPEC.validation.single_split_valid_size).select(ID, FOLD)


@register("split_kfold", sql(kfold_sql() + " SELECT id, fold FROM kf_5"))
def split_kfold(spark, sf):
    train, _ = _tt(spark, sf)
    return kfold(train.select(ID), ID, 5, SEED).select(ID, FOLD)


@register("split_fold_filter", sql(folds_sql() + " SELECT t.id, t.sale_price FROM train t JOIN folds_5 f USING (id) "
                                                 "WHERE f.fold = 2"))
def split_fold_filter(spark, sf):
    train, _ = _tt(spark, sf)
    folded = assign_folds(train, TARGET, ID, 5, SEED, SPEC.validation.stratify_bins)
    return folded.filter(F.col(FOLD) == 2).select(ID, TARGET)


_W7_COLS = NUMERIC_FE_ORDERED


@register("fold_train_stats", sql(folds_sql() + f"""
, stacked AS (SELECT t.*, tf.tf AS train_fold FROM train_fe t JOIN folds_5 f USING (id)
              JOIN (SELECT CAST(unnest(range(0, 5)) AS INTEGER) AS tf) tf ON f.fold <> tf.tf)
SELECT train_fold, unnest([{', '.join("{'column': '" + x + "', 'n': count(" + x + "), 'mean': round(avg(" + x + "::DOUBLE), 6), 'median': round(median(" + x + "::DOUBLE), 6)}" for x in _W7_COLS)}], recursive := true)
FROM stacked GROUP BY train_fold"""))
def fold_train_stats(spark, sf):
    """Per fold, count / mean / median of every numeric feature on that fold's training rows, no row copied."""
    train, _ = _fe(spark, sf)
    folded = written_table(assign_folds(train, TARGET, ID, 5, SEED, SPEC.validation.stratify_bins).select(FOLD, *_W7_COLS), "folded")
    folds = list(range(5))
    mom = fold_moments(folded, _W7_COLS, FOLD, folds)
    med = fold_quantiles(folded, _W7_COLS, [0.5], FOLD, folds, folds)
    rows = [(f, x, int(mom[f][x][0]), mom[f][x][1], med[f].get(x, {}).get(0.5)) for f in folds for x in _W7_COLS]
    return r6(spark.createDataFrame(rows, "train_fold int, column string, n long, mean double, median double"))

# ------------------------------------------------------------------ U: unions


@register("union_train_test", sql("SELECT *, 'train' AS split FROM train UNION ALL BY NAME "
                                  "SELECT *, 'test' AS split FROM test"))
def union_train_test(spark, sf):
    train, test = _tt(spark, sf)
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test")), allowMissingColumns=True))


@register("union_split_back", sql("SELECT * FROM test"))
def union_split_back(spark, sf):
    both = union_train_test(spark, sf)
    return both.filter(F.col("split") == "test").drop("split", TARGET)


QUERIES, ORACLE = Q, O
