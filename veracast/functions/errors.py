"""Row-level forecast errors. Two sign conventions exist on purpose; see each function."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracast.functions.numeric import ratio


def product_errors(actual: Column, forecast: Column) -> dict[str, Column]:
    """Product grain: ``actual - forecast``, positive means under-forecast.

    A zero actual has no percentage error (null), and 0 against 0 has no sMAPE term.
    """
    signed = actual - forecast
    size = F.abs(actual) + F.abs(forecast)
    return {
        "signed_error": signed,
        "abs_error": F.abs(signed),
        "squared_error": signed * signed,
        "ape": F.when(actual != 0, ratio(F.abs(signed), actual)),
        "smape_element": F.when(size > 0, ratio(F.abs(signed) * 2, size)),
        "is_zero_actual": actual == 0,
    }


def signed_error_share(actual: Column, forecast: Column) -> Column:
    """Back-test grain: ``(forecast - actual) / actual``, and 0 when nothing was sold."""
    return F.when(actual == 0, 0.0).otherwise(ratio(forecast - actual, actual))


def safe_tracking_signal(total_error: Column, mean_abs_error: Column) -> Column:
    """Cumulative error in units of the mean absolute error; 0 for a perfect series."""
    return F.when(mean_abs_error > 0, ratio(total_error, mean_abs_error)).otherwise(0.0)
