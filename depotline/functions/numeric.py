"""Null-safe arithmetic that keeps dataframe semantics under ANSI mode."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

_NUMBER = r"^\s*+[+-]?+(?:\d++\.?+\d*+|\.\d++)(?:[eE][+-]?+\d++)?+\s*$"


def to_number(text: Column) -> Column:
    """Tolerant text-to-double; unreadable text becomes null.

    The shape is tested first because a plain cast also accepts ``1d`` or ``2f``.
    """
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields null for a zero or missing denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def cap_above(value: Column, cap: Column) -> Column:
    """Upper clip that keeps null as null (``least`` would return the cap)."""
    return F.when(value > cap, cap).otherwise(value)


def floor_below(value: Column, floor: float | Column) -> Column:
    limit = floor if isinstance(floor, Column) else F.lit(floor)
    return F.when(value < limit, limit).otherwise(value)


def is_true(condition: Column) -> Column:
    """A comparison with null counts as false."""
    return F.coalesce(condition, F.lit(False))


def mean_of(columns: list[Column]) -> Column:
    return reduce(add, columns) / F.lit(len(columns))


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson r over rows where both are present; constant input gives null."""
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.stddev_samp(xs) * F.stddev_samp(ys)
    return F.try_divide(F.covar_samp(xs, ys), F.nullif(spread, F.lit(0.0)))


def slope(x: Column, y: Column) -> Column:
    return F.regr_slope(y.cast("double"), x.cast("double"))


def intercept(x: Column, y: Column) -> Column:
    return F.regr_intercept(y.cast("double"), x.cast("double"))
