"""Run specification: plain frozen dataclasses, decided on the driver.

Two presets: ``house_prices_spec()`` carries the column names and defaults
of the original house-price run; ``fixture_spec()`` maps the same roles onto
the ``fx`` table derived from orders/lineitem/customer.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from plinth.functions.metrics import RMSE, Metric

# ---------------------------------------------------------------------------
# These must equal the original run for equal results.
#   derived feature names: SaleMonthIndex, YearsSinceSale2010, TotalUsableArea,
#     TotalBathrooms, HouseAgeAtSale, YearsSinceRemodel, and "{left}_x_{right}"
#   reference year of the years-since feature: 2010
#   bathroom weights: FullBath 1.0, HalfBath 0.5, BsmtFullBath 1.0, BsmtHalfBath 0.5
#   area parts: TotalBsmtSF, 1stFlrSF, 2ndFlrSF, GrLivArea, GarageArea
#   interaction pairs: (OverallQual, GrLivArea), (GarageCars, GarageArea), (TotalBsmtSF, 1stFlrSF)
#   seed 42; stratify bins 10; holdout share 0.2; folds 5
#   constant threshold 1 distinct value; correlation threshold 0.995
#   clip quantiles 0.01 / 0.99 (clipping off); imputers median / most_frequent
#   grids: ridge alpha 1, 3, 10; lasso alpha 0.0005, 0.001 (max_iter 10000);
#     elasticnet alpha 0.001, l1_ratio 0.5 (max_iter 10000);
#     random_forest 600 trees, no depth limit, min leaf 1;
#     xgboost / lightgbm / catboost / dnn present but disabled
#   ensembles: min 2 members; average, voting (median), stacking with ridge alpha 1
#   experiment name: "{model}__" + first 10 hex digits of md5(sorted-key JSON of params)
#   missing-value token for categoricals: "Missing"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class DataSpec:
    target_col: str = "SalePrice"
    id_col: str = "Id"
    target_transform: str = "log1p"
    id_as_feature: bool = False


@dataclass(frozen=True)
class ValidationSpec:
    stratify_bins: int = 10
    single_split_valid_size: float = 0.2
    shuffle: bool = True
    compare_n_splits: tuple = (5,)
    primary_n_splits: int = 5
    metric: Metric = RMSE              # what scores, ranks and chooses experiments


@dataclass(frozen=True)
class ProfileSpec:
    enabled: bool = True
    top_numeric_features: int = 15
    missing_top_k: int = 20
    hist_bins: int = 40


@dataclass(frozen=True)
class PrepSpec:
    scale_numeric_for_linear: bool = True
    scale_numeric_for_knn: bool = True
    numeric_imputer_strategy: str = "median"
    categorical_imputer_strategy: str = "most_frequent"
    drop_constant_features: bool = True
    constant_threshold_unique: int = 1
    drop_correlated_features: bool = True
    correlation_threshold: float = 0.995
    clip_outliers: bool = False
    outlier_lower_quantile: float = 0.01
    outlier_upper_quantile: float = 0.99
    exact_quantiles: bool = True        # False: percentile_approx (opt-in for size)
    approx_accuracy: int = 100_000
    missing_token: str = "Missing"


@dataclass(frozen=True)
class FeatureSpec:
    enabled: bool = True
    add_time_features: bool = True
    add_total_area: bool = True
    add_total_bathrooms: bool = True
    add_house_age: bool = True
    add_interactions: bool = True
    year_col: str = "YrSold"
    month_col: str = "MoSold"
    built_col: str = "YearBuilt"
    remodel_col: str = "YearRemodAdd"
    area_cols: tuple = ("TotalBsmtSF", "1stFlrSF", "2ndFlrSF", "GrLivArea", "GarageArea")
    bath_weights: tuple = (("FullBath", 1.0), ("HalfBath", 0.5), ("BsmtFullBath", 1.0), ("BsmtHalfBath", 0.5))
    interaction_pairs: tuple = (("OverallQual", "GrLivArea"), ("GarageCars", "GarageArea"), ("TotalBsmtSF", "1stFlrSF"))
    reference_year: int = 2010
    month_index_name: str = "SaleMonthIndex"
    years_since_name: str = "YearsSinceSale2010"
    total_area_name: str = "TotalUsableArea"
    total_bath_name: str = "TotalBathrooms"
    age_name: str = "HouseAgeAtSale"
    remodel_name: str = "YearsSinceRemodel"


@dataclass(frozen=True)
class ModelSpec:
    name: str
    enabled: bool = True
    grids: tuple = ()


@dataclass(frozen=True)
class EnsembleSpec:
    enabled: bool = True
    min_models: int = 2
    average: bool = True
    voting: bool = True
    stacking: bool = True
    stacker_models: tuple = (("ridge", (("alpha", 1.0),)),)
    stack_score: str = "in_sample"      # or "fold": scored on rows the meta-model did not see


@dataclass(frozen=True)
class OutputSpec:
    save_submission: bool = True
    out_dir: str | None = None          # None: a fresh folder under spark.checkpoint.dir


def _p(**kw) -> tuple:
    return tuple(sorted(kw.items()))


DEFAULT_MODELS = (
    ModelSpec("ridge", True, (_p(alpha=1.0), _p(alpha=3.0), _p(alpha=10.0))),
    ModelSpec("lasso", True, (_p(alpha=0.0005, max_iter=10000), _p(alpha=0.001, max_iter=10000))),
    ModelSpec("elasticnet", True, (_p(alpha=0.001, l1_ratio=0.5, max_iter=10000),)),
    ModelSpec("random_forest", True, (_p(n_estimators=600, max_depth=None, min_samples_leaf=1,
                                         random_state=42, n_jobs=-1),)),
    ModelSpec("xgboost", False, (_p(n_estimators=1500, learning_rate=0.03, max_depth=4, subsample=0.8,
                                    colsample_bytree=0.8, random_state=42, n_jobs=-1),)),
    ModelSpec("lightgbm", False, (_p(n_estimators=1500, learning_rate=0.03, num_leaves=31, subsample=0.8,
                                     colsample_bytree=0.8, random_state=42, n_jobs=-1),)),
    ModelSpec("catboost", False, (_p(iterations=1500, learning_rate=0.03, depth=6, random_seed=42,
                                     verbose=False),)),
    ModelSpec("dnn", False, (_p(hidden_dims=(256, 128), dropout=0.1, epochs=50, batch_size=128,
                                learning_rate=0.001, random_state=42),)),
)


@dataclass(frozen=True)
class Spec:
    seed: int = 42
    data: DataSpec = field(default_factory=DataSpec)
    validation: ValidationSpec = field(default_factory=ValidationSpec)
    profile: ProfileSpec = field(default_factory=ProfileSpec)
    prep: PrepSpec = field(default_factory=PrepSpec)
    features: FeatureSpec = field(default_factory=FeatureSpec)
    models: tuple = DEFAULT_MODELS
    ensembles: EnsembleSpec = field(default_factory=EnsembleSpec)
    output: OutputSpec = field(default_factory=OutputSpec)
    parallelism: int = 4                 # fold fits submitted at once from the driver

    def validate(self) -> "Spec":
        v = self.validation
        if v.primary_n_splits not in v.compare_n_splits:
            raise ValueError(f"primary_n_splits={v.primary_n_splits} must be one of compare_n_splits={v.compare_n_splits}")
        if self.prep.numeric_imputer_strategy not in ("mean", "median", "most_frequent", "constant"):
            raise ValueError(f"unknown numeric imputer strategy {self.prep.numeric_imputer_strategy!r}")
        if self.prep.categorical_imputer_strategy not in ("most_frequent", "constant"):
            raise ValueError(f"unknown categorical imputer strategy {self.prep.categorical_imputer_strategy!r}")
        if self.ensembles.stack_score not in ("in_sample", "fold"):
            raise ValueError(f"unknown stack score {self.ensembles.stack_score!r}")
        return self

    def with_models(self, *models: ModelSpec) -> "Spec":
        return replace(self, models=tuple(models))


def house_prices_spec() -> Spec:
    return Spec().validate()


def fixture_spec() -> Spec:
    """The same roles on the ``fx`` table (lower snake case names)."""
    fe = FeatureSpec(
        year_col="yr_sold", month_col="mo_sold", built_col="year_built", remodel_col="year_remod",
        area_cols=("area_bsmt", "area_1st", "area_2nd", "area_living", "area_garage"),
        bath_weights=(("full_bath", 1.0), ("half_bath", 0.5), ("bsmt_full_bath", 1.0), ("bsmt_half_bath", 0.5)),
        interaction_pairs=(("overall_qual", "area_living"), ("garage_cars", "area_garage"), ("area_bsmt", "area_1st")),
        month_index_name="sale_month_index", years_since_name="years_since_sale_2010",
        total_area_name="total_usable_area", total_bath_name="total_bathrooms",
        age_name="house_age_at_sale", remodel_name="years_since_remodel",
    )
    return Spec(data=DataSpec(target_col="sale_price", id_col="id"), features=fe).validate()
