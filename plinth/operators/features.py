"""Feature derivation (one projection) and the numeric/categorical split."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.exprs import c, interaction, interval_between, is_numeric, sum_columns, weighted_sum
from plinth.spec import FeatureSpec


def derived_columns(spec: FeatureSpec, columns: list[str]) -> dict[str, Column]:
    """Name -> expression of every derived column whose inputs exist, in order."""
    have = set(columns)
    out: dict[str, Column] = {}
    if not spec.enabled:
        return out
    if spec.add_time_features:
        if {spec.year_col, spec.month_col} <= have:
            out[spec.month_index_name] = c(spec.year_col) * 12 + c(spec.month_col)
        if spec.year_col in have:
            out[spec.years_since_name] = F.lit(spec.reference_year) - c(spec.year_col)
    if spec.add_total_area:
        parts = [a for a in spec.area_cols if a in have]
        if parts:
            out[spec.total_area_name] = sum_columns(parts).cast("double")
    if spec.add_total_bathrooms:
        baths = [(b, w) for b, w in spec.bath_weights if b in have]
        if baths:
            out[spec.total_bath_name] = weighted_sum(baths)
    if spec.add_house_age:
        if {spec.year_col, spec.built_col} <= have:
            out[spec.age_name] = interval_between(spec.year_col, spec.built_col)
        if {spec.year_col, spec.remodel_col} <= have:
            out[spec.remodel_name] = interval_between(spec.year_col, spec.remodel_col)
    if spec.add_interactions:
        for left, right in spec.interaction_pairs:
            if left in have and right in have:
                out[f"{left}_x_{right}"] = interaction(left, right)
    return out


def add_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    exprs = derived_columns(spec, df.columns)
    return df.withColumns(exprs) if exprs else df


def feature_types(df: DataFrame, exclude: tuple = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names from the schema; booleans count as categorical."""
    numeric = [f.name for f in df.schema.fields if f.name not in exclude and is_numeric(f.dataType)]
    categorical = [f.name for f in df.schema.fields if f.name not in exclude and f.name not in numeric]
    return numeric, categorical


class FeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Stateless ``Transformer``: all derived columns in one ``withColumns``."""

    specJson = Param(Params._dummy(), "specJson", "FeatureSpec as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, specJson: str | None = None):
        super().__init__()
        self._setDefault(specJson=json.dumps(asdict(FeatureSpec())))
        self._set(**self._input_kwargs)

    @classmethod
    def from_spec(cls, spec: FeatureSpec) -> "FeatureEngineer":
        return cls(specJson=json.dumps(asdict(spec)))

    def spec(self) -> FeatureSpec:
        raw = json.loads(self.getOrDefault(self.specJson))
        for k, v in list(raw.items()):
            if isinstance(v, list):
                raw[k] = tuple(tuple(x) if isinstance(x, list) else x for x in v)
        return FeatureSpec(**raw)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_features(dataset, self.spec())
