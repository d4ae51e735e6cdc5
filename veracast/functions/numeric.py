"""Arithmetic that behaves the same under ANSI mode and in other SQL engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den``, null when the divisor is zero or null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio_or(num: Column, den: Column, default: float) -> Column:
    return F.coalesce(ratio(num, den), F.lit(default))


def pct(part: Column, whole: Column) -> Column:
    """Share in percent, 0 for an empty whole."""
    return ratio_or(part, whole, 0.0) * 100


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding of a double after dropping binary noise past the 12th decimal.

    A sum whose last bit depends on partition order then rounds the same way on every run.
    """
    return F.round(value.cast("decimal(38,12)"), digits).cast("double")


def steady(value: Column) -> Column:
    """The value without the last-bit noise of a parallel sum, for comparing and ordering.

    Two algorithms with equal errors must tie on every run, and a KPI of exactly 30 must not
    miss its limit because its terms were added in another order. Cheap: stays a double.
    """
    return F.rint(value * 1e9) / 1e9


def between(value: Column, low: float, high: float) -> Column:
    """Clamp; a null value stays null (``greatest``/``least`` alone would skip it)."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def correlation(x: Column, y: Column, min_pairs: int) -> Column:
    """Pearson over complete pairs; null below ``min_pairs`` or when either side is constant.

    ``F.corr`` divides by zero on constant input under ANSI, hence the moments.
    """
    complete = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(complete, x.cast("double")), F.when(complete, y.cast("double"))
    r = ratio(F.covar_pop(xs, ys), F.stddev_pop(xs) * F.stddev_pop(ys))
    return F.when(F.count_if(complete) >= min_pairs, r)
