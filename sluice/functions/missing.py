"""Missing values and comparisons that never let NaN through.

Spark holds NaN above every number, so ``NaN >= 0`` is true there; a score that isn't a number must
satisfy no bound. All predicates below are false, never null, for null and NaN.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating-point column."""
    c = F.col(name)
    return (c.isNull() | F.isnan(c)) if isinstance(df.schema[name].dataType, (DoubleType, FloatType)) else c.isNull()


def is_number(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value.cast("double"))


def is_finite(value: Column) -> Column:
    v = value.cast("double")
    return is_number(v) & (F.abs(v) < F.lit(float("inf")))


def at_least(value: Column, bound: float) -> Column:
    return is_number(value) & (value >= F.lit(bound))


def at_most(value: Column, bound: float) -> Column:
    return is_number(value) & (value <= F.lit(bound))


def above(value: Column, bound: float) -> Column:
    return is_number(value) & (value > F.lit(bound))


def finite_or_null(value: Column) -> Column:
    return F.when(is_finite(value), value.cast("double"))


def as_key(df: DataFrame, name: str) -> Column:
    """For grouping: NaN and null are the same missing key."""
    return F.when(~is_missing(df, name), F.col(name))
