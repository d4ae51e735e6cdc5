"""Forecast error turned into safety stock, stock-out risk and its link to lead time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracast.config import Settings
from veracast.functions.numeric import between, correlation, rounded, steady
from veracast.operators.accuracy import best_algorithm

MIN_PRODUCTS = 3


def volatility(columns: list[str], settings: Settings = Settings()) -> tuple[str, Column]:
    """Name and value of the first preferred metric present; WAPE is a percentage."""
    lower = {c.lower() for c in columns}
    name = next((m for m in settings.volatility_preference if m in lower), "none")
    if name == "none":
        return name, F.lit(0.0)
    value = F.col(name) / 100.0 if name == "wape" else F.col(name)
    return name, F.coalesce(value, F.lit(0.0))


def risk_level(value: Column, settings: Settings = Settings()) -> Column:
    low, medium, high = settings.risk_cuts
    value = steady(value)
    return (
        F.when(value < low, "LOW")
        .when(value < medium, "MEDIUM")
        .when(value < high, "HIGH")
        .otherwise("CRITICAL")
    )


def leadtime_impact(
    perf: DataFrame,
    master_lead_time: DataFrame | None = None,
    settings: Settings = Settings(),
    keep_metrics: bool = False,
) -> DataFrame:
    """Safety-stock days of the best algorithm (by MAPE) per product and window.

    ``master_lead_time`` (product_id, lead_time_days) has one row per product and grows with
    the catalogue, so it is not forced into a broadcast; products it misses use the default.
    ``keep_metrics`` carries the best row's WAPE and sMAPE along for ``leadtime_correlation``.
    """
    default = F.lit(settings.default_lead_time_days)
    name, value = volatility(perf.columns, settings)
    best = best_algorithm(perf, "mape")
    if master_lead_time is None:
        days, source = default, F.lit("default")
    else:
        known = F.col("_master_days")
        best = best.join(
            master_lead_time.select(
                "product_id", F.col("lead_time_days").cast("int").alias("_master_days")
            ),
            "product_id",
            "left",
        )
        days = F.coalesce(known, default)
        source = F.when(known.isNotNull(), "masterdata").otherwise("default")
    level = F.col("risk_severity")
    metrics = [c for c in ("wape", "smape") if keep_metrics and c in perf.columns]
    return best.select(
        "product_id",
        "analytical_window_months",
        days.cast("int").alias("lead_time_days"),
        source.alias("lead_time_days_source"),
        F.lit(name).alias("volatility_metric_name"),
        between(value, 0.0, 1.0).alias("volatility_metric_value"),
        *metrics,
    ).select(
        "*",
        rounded(F.col("lead_time_days") * F.col("volatility_metric_value"), 2).alias(
            "safety_stock_days_required"
        ),
        risk_level(F.col("volatility_metric_value"), settings).alias("risk_severity"),
    ).select(
        "*", level.isin("HIGH", "CRITICAL").alias("stockout_risk_flag")
    )


def risk_distribution(impact: DataFrame) -> DataFrame:
    return impact.groupBy("analytical_window_months", "risk_severity").agg(
        F.count(F.lit(1)).alias("n_products"),
        F.count_if("stockout_risk_flag").alias("n_at_risk"),
    )


def leadtime_correlation(impact: DataFrame) -> DataFrame:
    """Pearson of lead time against WAPE and sMAPE across products, two rows per window.

    ``impact`` has the metrics of its best rows (``keep_metrics``), so nothing is joined. Null
    with fewer than three products or pairs, and when either side is constant. The correlation
    folds on the map side.
    """
    days = F.col("lead_time_days")
    wide = impact.groupBy("analytical_window_months").agg(
        F.count(F.lit(1)).alias("n_products"),
        correlation(days, F.col("wape"), MIN_PRODUCTS).alias("wape"),
        correlation(days, F.col("smape"), MIN_PRODUCTS).alias("smape"),
    )
    return wide.unpivot(
        ["analytical_window_months", "n_products"],
        ["wape", "smape"],
        "corr_metric_name",
        "correlation_value",
    ).select("analytical_window_months", "corr_metric_name", "correlation_value", "n_products")
