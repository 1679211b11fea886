"""Pluggable scorer: an MLlib ``Evaluator`` for any registered metric.

``isLargerBetter()`` is the metric's direction, so ``CrossValidator``/``TrainValidationSplit``
pick the smallest error or the largest score.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.metrics import MAPE, R2, RMSE, RMSLE, Metric

METRICS: dict[str, Metric] = {m.name: m for m in (RMSE, RMSLE, MAPE, R2)}


def register_metric(metric: Metric) -> Metric:
    """Make a metric known to the evaluator by its name."""
    METRICS[metric.name] = metric
    return metric


class RegressionScoreEvaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """Both columns are taken as they are, on the scale of the label column."""

    metricName = Param(Params._dummy(), "metricName", "name of a registered metric", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, metricName: str = "rmse", labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(metricName="rmse", labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _metric(self) -> Metric:
        return METRICS[self.getOrDefault(self.metricName)]

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(dataset.agg(self._metric().of(F.col(self.getLabelCol()), F.col(self.getPredictionCol()))).first()[0])

    def isLargerBetter(self) -> bool:
        return self._metric().larger_is_better
