"""What the human planner adds over the best algorithm, per product and window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracast.config import NAIVE_LABELS, PLANNER_LABELS
from veracast.functions.numeric import rounded, steady


def forecast_value_added(perf: DataFrame) -> DataFrame:
    """``fva_value`` = best algorithm's WAPE minus the planner's; positive favours the planner.

    One conditional aggregation instead of three filtered copies joined back, so two planner
    labels for the same product cannot multiply rows (the better one counts). Products that
    have no algorithm in a window have no row.
    """
    name = F.lower("algo_name")
    naive, planner = name.isin(*NAIVE_LABELS), name.isin(*PLANNER_LABELS)
    model = ~(naive | planner)
    wape = F.col("wape")
    candidate = F.struct(
        wape.isNull().alias("missing"),
        steady(wape).alias("order"),
        F.col("algo_name"),
        wape.alias("wape"),
        F.col("n_obs"),
    )
    value = F.col("fva_value")
    return (
        perf.groupBy("product_id", "analytical_window_months")
        .agg(
            F.min(F.when(model, candidate)).alias("_best"),
            F.min(F.when(naive, wape)).alias("naive_error_metric"),
            F.min(F.when(planner, wape)).alias("planner_error_metric"),
        )
        .filter(F.col("_best").isNotNull())
        .withColumn("algo_error_metric", F.col("_best.wape"))
        .withColumn(
            "fva_value", rounded(F.col("algo_error_metric") - F.col("planner_error_metric"), 4)
        )
        .select(
            "product_id",
            "analytical_window_months",
            "naive_error_metric",
            "algo_error_metric",
            "planner_error_metric",
            "fva_value",
            F.when(value > 0, "Positive")
            .when(value == 0, "Neutral")
            .when(value < 0, "Negative")
            .otherwise("Unknown")
            .alias("fva_flag"),
            F.col("_best.n_obs").alias("n_obs"),
        )
    )
