"""Rolling-origin back-test: many hold-outs of a product from one sorted pass.

Input: one row per product and month (``sku_id``, ``date_month``, ``actual_qty``). An origin is a
row that a hold-out would train up to. What the models need of the rows up to there are sums, which
running windows carry, so an origin costs one row and not a pass over its history. All windows have
one order, hence one shuffle and one sort; a product's window holds its months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracast.functions.numeric import ratio, ratio_or
from veracast.operators.baselines import history

MODELS = ("mean", "naive", "line")


def rolling_origins(
    monthly: DataFrame, origins: int = 24, horizon: int = 6, min_train: int = 12
) -> DataFrame:
    """Forecasts of each product's next ``horizon`` rows from each of its last ``origins`` origins.

    The newest origin leaves ``horizon`` rows, each older one a row more. ``steps`` counts rows from
    the origin. Null quantities train nothing: without any before an origin its mean and line are
    null, and the naive forecast is the origin's own quantity or null. A line needs two of them and
    else is the mean. Forecasts aren't negative.
    """
    running = history().rowsBetween(Window.unboundedPreceding, 0)
    step = F.row_number().over(history()).cast("double")
    known = F.col("actual_qty").isNotNull()
    x, y = F.when(known, F.col("_x")), F.col("actual_qty").cast("double")

    def total(value: Column) -> Column:
        return F.sum(value).over(running)

    states = (
        monthly.withColumns(
            {"_x": step, "_rows": F.count(F.lit(1)).over(Window.partitionBy("sku_id"))}
        )
        .withColumns(
            {
                "_n": F.count(y).over(running).cast("double"),
                "_sx": total(x),
                "_sy": total(y),
                "_sxx": total(x * x),
                "_sxy": total(x * y),
                # The rows that this one is an origin for.
                "_next": F.collect_list(F.struct("date_month", "actual_qty")).over(
                    history().rowsBetween(1, horizon)
                ),
            }
        )
        .filter(F.col("_x") >= min_train)
        .filter((F.col("_rows") - F.col("_x")).between(horizon, horizon + origins - 1))
    )
    mean = ratio(F.col("_sy"), F.col("_n"))
    slope = ratio_or(
        F.col("_n") * F.col("_sxy") - F.col("_sx") * F.col("_sy"),
        F.col("_n") * F.col("_sxx") - F.col("_sx") * F.col("_sx"),
        0.0,
    )
    ahead = states.select(
        "sku_id",
        F.col("date_month").alias("origin_month"),
        F.col("_x"),
        mean.alias("_mean"),
        F.col("actual_qty").cast("double").alias("_last"),
        slope.alias("_slope"),
        (mean - slope * ratio(F.col("_sx"), F.col("_n"))).alias("_intercept"),
        F.posexplode("_next").alias("_at", "_row"),
    )
    steps = (F.col("_at") + 1).cast("int")

    def shown(forecast: Column) -> Column:
        return F.when(forecast.isNotNull(), F.greatest(F.lit(0.0), forecast))

    return ahead.select(
        "sku_id",
        "origin_month",
        steps.alias("steps"),
        F.col("_row.date_month").alias("date_month"),
        F.col("_row.actual_qty").alias("actual_qty"),
        shown(F.col("_mean")).alias("forecast_mean"),
        shown(F.col("_last")).alias("forecast_naive"),
        shown(F.col("_intercept") + F.col("_slope") * (F.col("_x") + steps)).alias("forecast_line"),
    )


def accuracy_by_steps(forecasts: DataFrame) -> DataFrame:
    """Errors of each model by how far ahead it looked, over all products and origins."""
    models = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("model"), F.col(f"forecast_{m}").alias("forecast"))
                for m in MODELS
            ]
        )
    )
    rows = forecasts.select("steps", "actual_qty", models.alias("_m")).select(
        "steps", "actual_qty", "_m.*"
    )
    error = F.col("actual_qty") - F.col("forecast")
    share = F.when(F.col("actual_qty") != 0, F.abs(error) / F.abs(F.col("actual_qty")))
    return rows.groupBy("model", "steps").agg(
        F.count(error).alias("n_obs"),
        (F.avg(share) * 100).alias("mape"),
        (ratio(F.sum(F.abs(error)), F.sum(F.when(error.isNotNull(), F.abs("actual_qty")))) * 100).alias("wape"),
        F.avg(error).alias("bias"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )
