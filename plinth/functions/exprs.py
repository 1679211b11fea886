"""Small expression builders shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def c(name: str) -> Column:
    """Column by name; backticks make names like ``1stFlrSF`` or ``a.b`` safe."""
    return F.col(f"`{name}`")


def sum_columns(names: list[str], fill: float = 0.0) -> Column:
    """Row sum of the columns with missing treated as ``fill``."""
    return reduce(lambda a, b: a + b, [F.coalesce(c(n), F.lit(fill)) for n in names])


def weighted_sum(weights: list[tuple[str, float]], fill: float = 0.0) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(c(n), F.lit(fill)) * F.lit(float(w)) for n, w in weights])


def interaction(left: str, right: str, fill: float = 0.0) -> Column:
    return F.coalesce(c(left), F.lit(fill)) * F.coalesce(c(right), F.lit(fill))


def interval_between(later: str, earlier: str) -> Column:
    return c(later) - c(earlier)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType) and not isinstance(dtype, T.BooleanType)


def nan_to_null(col: Column) -> Column:
    """NULL is the only missing marker inside the engine."""
    return F.when(F.isnan(col), None).otherwise(col)


def rounded(col: Column, digits: int = 6) -> Column:
    return F.round(col.cast("double"), digits)
