"""Regression metrics as aggregate expressions, and the description of a metric a run is scored by."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from plinth.functions.target import inverse_target


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg(F.pow(y - p, 2)))


def rmsle(y: Column, p: Column) -> Column:
    """Clip predictions at 0, log1p both sides, then RMSE."""
    return F.sqrt(F.avg(F.pow(F.log1p(y) - F.log1p(F.greatest(p, F.lit(0.0))), 2)))


def mape(y: Column, p: Column) -> Column:
    """Mean absolute percentage error; rows whose target is 0 don't count."""
    return F.avg(F.abs(y - p) / F.nullif(F.abs(y), F.lit(0.0)))


def r2(y: Column, p: Column) -> Column:
    """Share of the variance explained; NULL for a constant target."""
    return 1 - F.sum(F.pow(y - p, 2)) / F.nullif(F.regr_syy(y, y), F.lit(0.0))


@dataclass(frozen=True)
class Metric:
    """An aggregate of (target, prediction) and its direction.

    ``aggregate`` is any aggregate expression, a grouped-aggregate pandas function included.  With
    ``original_scale`` it sees both columns after the inverse of the target transform, otherwise on
    the scale that the models are fitted on.
    """

    name: str
    aggregate: Callable[[Column, Column], Column]
    larger_is_better: bool = False
    original_scale: bool = False

    def of(self, y: Column, p: Column, transform: str = "none") -> Column:
        if self.original_scale:
            y, p = inverse_target(y, transform), inverse_target(p, transform)
        return self.aggregate(y, p)

    def order(self, score: float) -> float:
        """A number that is smaller for a better score; a score that is no number comes last."""
        if score is None or score != score:
            return float("inf")
        return -score if self.larger_is_better else score


RMSE = Metric("rmse", rmse)
RMSLE = Metric("rmsle", rmsle)
MAPE = Metric("mape", mape, original_scale=True)
R2 = Metric("r2", r2, larger_is_better=True)
