"""Seasonal baselines as window expressions: no model library, no Python worker, one shuffle.

Input: one row per product and month (``sku_id``, ``date_month``, ``actual_qty``). Each product's
last ``horizon`` rows are held out and forecast from the rows before; products with fewer than
``min_train`` of those are left out. Seasons are calendar months, so a missing month shifts nothing.
Every window is partitioned by product, which one shuffle serves, and holds at most its history.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracast.functions.months import month_index
from veracast.functions.numeric import ratio
from veracast.operators.baselines import history

SEASON = 12
HALF = SEASON // 2


def product():
    return Window.partitionBy("sku_id")


def product_season():
    return Window.partitionBy("sku_id", "_season")


def _split(monthly: DataFrame, horizon: int, min_train: int) -> DataFrame:
    """``monthly`` with its month number, season, and the quantity where the row trains."""
    return (
        monthly.withColumns(
            {
                "_t": month_index(F.col("date_month")),
                "_season": F.month("date_month"),
                "_step": F.row_number().over(history()),
                "_rows": F.count(F.lit(1)).over(product()),
            }
        )
        .filter(F.col("_rows") - horizon >= min_train)
        .withColumn("_train", F.col("_step") <= F.col("_rows") - horizon)
        .withColumn("_y", F.when(F.col("_train"), F.col("actual_qty")))
        .withColumn("_x", F.when(F.col("_y").isNotNull(), F.col("_t").cast("double")))
    )


def _held_out(rows: DataFrame, name: str, forecast: Column, *more: Column) -> DataFrame:
    return rows.filter(~F.col("_train")).select(
        "sku_id",
        "date_month",
        "actual_qty",
        F.greatest(F.lit(0.0), forecast).alias(name),
        *more,
    )


def tslm_forecast(monthly: DataFrame, horizon: int = 6, min_train: int = 12) -> DataFrame:
    """Least squares on a trend and a dummy for each calendar month but one.

    The dummies' block of the normal equations is diagonal. Eliminating it leaves one equation for
    the slope, over deviations from each calendar month's own means; a season's level then is its
    mean minus the trend there. Where no calendar month was trained on twice, the trend is not
    identified and 0. A calendar month that was never trained on has no dummy to fit; it lies on
    the line through the means of all train rows.
    """
    x, y = F.col("_x"), F.col("_y")
    rows = _split(monthly, horizon, min_train).withColumns(
        {"_mean_x": F.avg(x).over(product_season()), "_mean_y": F.avg(y).over(product_season())}
    )
    off = x - F.col("_mean_x")
    rows = rows.withColumns(
        {
            "_xx": F.sum(off * off).over(product()),
            "_xy": F.sum(off * y).over(product()),
            "_all_x": F.avg(x).over(product()),
            "_all_y": F.avg(y).over(product()),
        }
    )
    slope = F.when(F.col("_xx") > 0, F.col("_xy") / F.col("_xx")).otherwise(0.0)
    level = F.coalesce("_mean_y", "_all_y") - slope * F.coalesce("_mean_x", "_all_x")
    return _held_out(rows, "forecast_tslm", level + slope * F.col("_t"), slope.alias("tslm_slope"))


def maws_forecast(monthly: DataFrame, horizon: int = 6, min_train: int = 12) -> DataFrame:
    """Moving average with seasonality: last year's deseasonalised mean times a seasonal index.

    The centred 2x12 average needs all 13 months around it; a gap leaves out the averages it
    touches. A calendar month's index is the mean ratio of its quantities to their averages,
    scaled so that twelve indices sum to 12; without a ratio it is 1 before scaling, so a product
    with less than 13 months in a row has no season. A month whose index is 0 has no say in the
    level. Without any that has, the forecast is 0.
    """
    by_month = product().orderBy("_t")
    around, edges = by_month.rangeBetween(-HALF, HALF), [
        by_month.rangeBetween(d, d) for d in (-HALF, HALF)
    ]
    y = F.col("_y")
    ends = sum((F.sum(y).over(edge) for edge in edges), F.lit(0.0))
    centred = F.when(F.count(y).over(around) == SEASON + 1, (F.sum(y).over(around) - ends / 2) / SEASON)
    rows = _split(monthly, horizon, min_train).withColumn("_ratio", ratio(y, centred))
    rows = rows.withColumns(
        {
            "_index": F.avg("_ratio").over(product_season()),
            "_times": F.count("_ratio").over(product_season()),
        }
    )
    # Each row adds its part of its season's index, so that a season counts once.
    share = F.when(F.col("_ratio").isNotNull(), F.col("_index") / F.col("_times"))
    seen = F.size(F.collect_set(F.when(F.col("_times") > 0, F.col("_season"))).over(product()))
    total = F.coalesce(F.sum(share).over(product()), F.lit(0.0)) + SEASON - seen
    rows = rows.withColumn("_scale", F.coalesce(ratio(F.lit(float(SEASON)), total), F.lit(1.0)))
    index = F.coalesce("_index", F.lit(1.0)) * F.col("_scale")
    rows = rows.withColumn("_index", index)
    first_of_year = F.col("_rows") - horizon - SEASON
    adjusted = F.when(F.col("_train") & (F.col("_step") > first_of_year), ratio(y, F.col("_index")))
    rows = rows.withColumn("_level", F.coalesce(F.avg(adjusted).over(product()), F.lit(0.0)))
    return _held_out(
        rows, "forecast_maws", F.col("_level") * F.col("_index"), F.col("_index").alias("maws_index")
    )
