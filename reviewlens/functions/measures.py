"""Numeric expressions: casts, units, counts, rates, rounding, scaling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTES_PER_HOUR = 60.0


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_key(c: Column | str) -> Column:
    """Join key as bigint; malformed text becomes null instead of an ANSI error."""
    return as_column(c).try_cast("bigint")


def to_number(c: Column | str) -> Column:
    """Numeric value as double; malformed text becomes null."""
    return as_column(c).try_cast("double")


def hours(minutes: Column | str) -> Column:
    return as_column(minutes) / MINUTES_PER_HOUR


def log_hours(minutes: Column | str) -> Column:
    return F.log1p(hours(minutes))


def count_where(condition: Column | str) -> Column:
    """Rows where the condition holds; null counts as not holding."""
    return F.count_if(as_column(condition))


def mean_where(condition: Column | str, value: Column | str) -> Column:
    """Mean of ``value`` over rows where the condition holds."""
    return F.avg(F.when(as_column(condition), as_column(value)))


def rate(flag: Column | str, null_as_zero: bool = True) -> Column:
    """Share of rows whose flag is true.

    By default a null flag stays in the denominator as a zero.  With
    ``null_as_zero=False`` rows without a flag are left out.
    """
    flag = as_column(flag)
    indicator = F.when(flag, 1)
    indicator = indicator.otherwise(0) if null_as_zero else indicator.when(~flag, 0)
    return F.avg(indicator)


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole``; null when the denominator is zero."""
    return F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))


def pct(part: Column | str, whole: Column | str, places: int | None = None) -> Column:
    """Percentage of two counts, optionally rounded half up."""
    value = ratio(part, whole) * 100
    return value if places is None else F.round(value, places)


def half_even(c: Column | str, places: int = 0) -> Column:
    """Banker's rounding, as NumPy and pandas round."""
    return F.bround(as_column(c), places)


def cap(c: Column | str, upper) -> Column:
    """Values above ``upper`` become ``upper``; null stays null."""
    c = as_column(c)
    return F.when(c > upper, F.lit(upper)).otherwise(c)


def relative_size(c: Column | str, largest: Column, scale: float, base: float) -> Column:
    """Marker size: share of the largest value, scaled and shifted."""
    return as_column(c) / largest * scale + base
