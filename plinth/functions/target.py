"""Target transforms (forward, inverse) and the non-negative clip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def transform_target(col: Column, mode: str) -> Column:
    """``log1p`` or identity; values <= -1 give NULL under log1p."""
    col = col.cast("double")
    return F.log1p(col) if mode == "log1p" else col


def inverse_target(col: Column, mode: str) -> Column:
    return F.expm1(col) if mode == "log1p" else col


def clip_nonneg(col: Column) -> Column:
    """``max(p, 0)``; NULL stays NULL (greatest would skip it)."""
    return F.when(col.isNotNull(), F.greatest(col, F.lit(0.0)))
