"""Baseline forecasts written as window expressions: no model, no Python worker.

Input: one row per product and month (``sku_id``, ``date_month``, ``actual_qty``), so a
product's window holds as many rows as it has months of history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veracast.functions.months import month_index


def history():
    return Window.partitionBy("sku_id").orderBy("date_month")


def trailing(months: int):
    """Frame over the ``months`` observed months before the current one."""
    return history().rowsBetween(-months, -1)


def naive_forecast(monthly: DataFrame) -> DataFrame:
    """The previous observed month, which need not be the previous calendar month."""
    return monthly.withColumn("forecast_naive", F.lag("actual_qty", 1).over(history()))


def naive_rows(rows: DataFrame) -> DataFrame:
    """The naive forecast as one more algorithm, for normalised rows that lack it.

    The lag runs over one row per product and month, so it is the same for any number of
    algorithms; months without a previous actual have no naive row.
    """
    months = rows.groupBy("sku_id", "date_month").agg(F.max("actual_qty").alias("actual_qty"))
    return (
        naive_forecast(months)
        .filter(F.col("forecast_naive").isNotNull())
        .select(
            "sku_id",
            F.lit("naive").alias("algo_name"),
            "date_month",
            "actual_qty",
            F.col("forecast_naive").alias("forecast_qty"),
        )
    )


def with_previous_actual(rows: DataFrame) -> DataFrame:
    """Normalised rows with ``forecast_naive``: the product's actual in its month before.

    All algorithms of a month share the actual, so a frame that ends a month earlier finds it.
    """
    earlier = (
        Window.partitionBy("sku_id")
        .orderBy(month_index(F.col("date_month")))
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return rows.withColumn("forecast_naive", F.last("actual_qty").over(earlier))


def moving_average_forecast(monthly: DataFrame, months: int = 3) -> DataFrame:
    """Mean of the ``months`` observed months before; null for the first one."""
    return monthly.withColumn(
        "forecast_moving_average", F.avg("actual_qty").over(trailing(months))
    )


def trend_forecast(monthly: DataFrame, horizon: int = 6, min_train: int = 12) -> DataFrame:
    """Straight line through the train rows, continued over the last ``horizon`` rows."""
    product = Window.partitionBy("sku_id")
    step = F.col("_step")
    train = step <= F.col("_rows") - horizon
    y, x = F.when(train, F.col("actual_qty")), F.when(train, step)
    return (
        monthly.withColumns(
            {
                "_step": F.row_number().over(history()).cast("double"),
                "_rows": F.count(F.lit(1)).over(product),
            }
        )
        .filter(F.col("_rows") - horizon >= min_train)
        .withColumns(
            {
                "_slope": F.regr_slope(y, x).over(product),
                "_intercept": F.regr_intercept(y, x).over(product),
            }
        )
        .filter(~train)
        .withColumn(
            "forecast_trend",
            F.greatest(F.lit(0.0), F.col("_intercept") + F.col("_slope") * step),
        )
        .select("sku_id", "date_month", "actual_qty", "forecast_trend")
    )
