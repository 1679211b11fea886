"""Estimators of the value stages: clip, impute, scale, encode.

Each takes its settings as keyword arguments of ``of`` and fits the same statistics as the recipe, so a
user's own ``Pipeline`` may hold them in any order; estimators and fitted stages can be saved.
``columns`` left out means every numeric column (every other one for categories) that is not in ``exclude``.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from plinth.functions.exprs import c
from plinth.functions.target import clip_nonneg, inverse_target
from plinth.operators.categories import categories
from plinth.operators.features import feature_types
from plinth.operators.prep import (ClipModel, ImputeModel, ScaleModel, fit_categorical_fill, fit_clip_bounds, fit_numeric_fill, fit_scaler,
                                   onehot_stages)
from plinth.operators.state import StateEstimator, StateModel


def _numeric(stage: StateEstimator, dataset: DataFrame) -> list[str]:
    given = stage.get("columns")
    return given if given is not None else feature_types(dataset, tuple(stage.get("exclude", [])))[0]


def _other(stage: StateEstimator, dataset: DataFrame, key: str = "columns") -> list[str]:
    given = stage.get(key)
    return given if given is not None else feature_types(dataset, tuple(stage.get("exclude", [])))[1]


class Clipper(StateEstimator):
    """``of(lower=0.01, upper=0.99, columns=None, exclude=[])``: values beyond the two quantiles become them."""

    def _fit(self, dataset: DataFrame) -> ClipModel:
        lower, upper = self.get("lower", 0.01), self.get("upper", 0.99)
        if not 0 <= lower <= upper <= 1:
            raise ValueError(f"clip quantiles {lower} and {upper} must be in order between 0 and 1")
        return ClipModel.of(bounds=fit_clip_bounds(dataset, _numeric(self, dataset), lower, upper)[None])


class Imputer(StateEstimator):
    """``of(numeric="median", categorical="most_frequent", columns=None, categorical_columns=None, exclude=[],
    token="Missing")``: missing values become the column's statistic; a column without values is dropped."""

    def _fit(self, dataset: DataFrame) -> ImputeModel:
        numeric = fit_numeric_fill(dataset, _numeric(self, dataset), self.get("numeric", "median"))[None]
        other = _other(self, dataset, "categorical_columns")
        return ImputeModel.of(numeric=numeric, categorical=fit_categorical_fill(
            dataset, other, self.get("categorical", "most_frequent"), constant=self.get("token", "Missing"))[None])


class Scaler(StateEstimator):
    """``of(columns=None, exclude=[])``: mean 0 and population standard deviation 1; constant columns become 0."""

    def _fit(self, dataset: DataFrame) -> ScaleModel:
        cols = _numeric(self, dataset)
        return ScaleModel.of(scale=fit_scaler(dataset, cols)[None] if cols else {})


class OneHot(StateEstimator):
    """``of(columns=None, exclude=[], suffix="__oh")``: a sparse vector column for each column; unknown and missing
    values are all zeros; a column without values gets none."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        found = categories(dataset, _other(self, dataset)).get(None, {})
        return PipelineModel(onehot_stages(dataset, found, self.get("suffix", "__oh"))[0])


class InverseTarget(StateModel):
    """``of(column=..., transform=..., prediction="prediction")``: the prediction on the target's own scale, at least 0."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        moved = inverse_target(c(self.get("prediction", "prediction")), self.get("transform", "none"))
        return dataset.withColumn(self.get("column"), clip_nonneg(moved))
