"""Hold-out back-test per product, and its lead-time impact."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracast.config import Settings
from veracast.functions.errors import signed_error_share
from veracast.functions.forecasters import Forecaster
from veracast.functions.numeric import rounded, steady
from veracast.shipping import ship

KEY = ["Material_ID", "Sales_Date"]


ColumnForecaster = Callable[[Column, int], Column]


def mean_column(train: Column, horizon: int) -> Column:
    """The train mean, as a column function: no Python worker."""
    total = F.aggregate(train, F.lit(0.0), lambda a, x: a + x)
    return F.array_repeat(F.greatest(total / F.size(train), F.lit(0.0)), horizon)


def last_column(train: Column, horizon: int) -> Column:
    """The last train value, as a column function."""
    return F.array_repeat(F.greatest(F.element_at(train, -1), F.lit(0.0)), horizon)


# Column functions that stand for a whole forecaster.
NATIVE = (mean_column, last_column)


def _forecast_column(train: Column, forecaster, horizon: int) -> Column:
    """Forecasts for a column of train arrays, clipped at 0.

    A column function is used as it is; a fitted model runs on one Arrow batch at a time.
    """
    if forecaster in NATIVE:
        return forecaster(train, horizon)

    def run(batch: pd.Series) -> pd.Series:
        if batch.empty:
            return pd.Series([], dtype=object)
        series = [np.asarray(values, dtype=float) for values in batch]
        clipped = np.maximum(np.asarray(forecaster(series, horizon), dtype=float), 0.0)
        return pd.Series(list(clipped))

    return F.pandas_udf(run, "array<double>")(train)


def train_series(
    sales: DataFrame, settings: Settings = Settings(), one_row_per_date: bool = False
) -> DataFrame:
    """(Material_ID, train, test): each product's rows before its last ones, and those.

    Sales are folded to one row per product and date, so a product's series is bounded by the
    calendar and not by how many rows it has (pass ``one_row_per_date=True`` if the source
    already is). Short histories are skipped.
    """
    horizon = settings.holdout_months
    if not one_row_per_date:
        sales = sales.groupBy(*KEY).agg(F.sum("Quantity_Sold").alias("Quantity_Sold"))
    point = F.struct(F.col("Sales_Date"), F.col("Quantity_Sold").cast("double").alias("qty"))
    return (
        sales.groupBy("Material_ID")
        .agg(F.array_sort(F.collect_list(point)).alias("series"))
        .withColumn("n_train", F.size("series") - horizon)
        .filter(F.col("n_train") >= settings.min_train_months)
        .select(
            "Material_ID",
            F.slice("series", 1, F.col("n_train")).getField("qty").alias("train"),
            F.slice("series", F.col("n_train") + 1, horizon).alias("test"),
        )
    )


def holdout_forecasts(
    sales: DataFrame,
    forecasters: Mapping[str, Forecaster | ColumnForecaster],
    settings: Settings = Settings(),
    one_row_per_date: bool = False,
) -> DataFrame:
    """Hold out each product's last rows and forecast them; short histories are skipped.

    Spark collects, sorts and splits the series (``train_series``); Python receives only the train
    arrays and returns the forecasts.
    """
    horizon = settings.holdout_months
    split = train_series(sales, settings, one_row_per_date)
    names = list(forecasters)
    if any(f not in NATIVE for f in forecasters.values()):
        ship(sales.sparkSession)
    forecast = split.select(
        "Material_ID",
        "test",
        *[_forecast_column(F.col("train"), forecasters[n], horizon).alias(n) for n in names],
    )
    return forecast.select(
        "Material_ID", F.inline(F.arrays_zip("test", *names))
    ).select(
        "Material_ID",
        F.col("test.Sales_Date").alias("Sales_Date"),
        F.col("test.qty").alias("Actual_Qty"),
        *names,
    )


def evaluate_backtest(
    holdout: DataFrame,
    planner: DataFrame,
    master: DataFrame,
    model: str = "Forecast_Prophet",
    settings: Settings = Settings(),
) -> DataFrame:
    """Join planner forecasts and lead times, then errors, impact in days and risk flags.

    ``model`` names the hold-out column whose error and impact are reported next to the
    planner's. A missing forecast leaves error and impact null and the risk LOW.
    """
    label = model.removeprefix("Forecast_")
    days = F.col("Mfg_LeadTime_Days") + F.col("Proc_LeadTime_Days")
    joined = (
        holdout.join(planner, KEY, "left")
        .join(
            master.select("Material_ID", "Mfg_LeadTime_Days", "Proc_LeadTime_Days"),
            "Material_ID",
            "left",
        )
        .withColumn("Total_Lead_Time_Days", days)
    )

    def judged(name: str, forecast: str) -> list[Column]:
        error = signed_error_share(F.col("Actual_Qty"), F.col(forecast))
        return [
            error.alias(f"Forecast_Error_Pct_{name}"),
            (F.abs(error) * F.col("Total_Lead_Time_Days")).alias(
                f"Safety_Stock_Impact_Days_{name}"
            ),
            F.when(steady(error) < settings.stockout_error, "HIGH")
            .otherwise("LOW")
            .alias(f"Stockout_Risk_Flag_{name}"),
        ]

    forecasts = [c for c in holdout.columns if c not in (*KEY, "Actual_Qty")]
    return joined.select(
        *KEY,
        "Actual_Qty",
        "System_Forecast_Qty",
        "Planner_Forecast_Qty",
        *forecasts,
        "Mfg_LeadTime_Days",
        "Proc_LeadTime_Days",
        "Total_Lead_Time_Days",
        *judged("Planner", "Planner_Forecast_Qty"),
        *judged(label, model),
        "Modified_By_User_ID",
        "Modification_Timestamp",
        "Reason_Code",
    )


def top_stockout_risks(
    evaluation: DataFrame, model: str = "Forecast_Prophet", n: int = 100
) -> DataFrame:
    """The ``n`` high-risk rows with the largest planner impact; ties go by product and date."""
    label = model.removeprefix("Forecast_")

    def percent(name: str) -> Column:
        share = F.col(f"Forecast_Error_Pct_{name}")
        return rounded(share * 100, 2).alias(f"Error_Pct_{name}")

    def impact(name: str) -> Column:
        days = F.col(f"Safety_Stock_Impact_Days_{name}")
        return rounded(days, 1).alias(f"Impact_Days_{name}")

    return (
        evaluation.filter(F.col("Stockout_Risk_Flag_Planner") == "HIGH")
        .select(
            *KEY,
            "Actual_Qty",
            "Planner_Forecast_Qty",
            model,
            "Mfg_LeadTime_Days",
            "Proc_LeadTime_Days",
            "Total_Lead_Time_Days",
            percent("Planner"),
            percent(label),
            impact("Planner"),
            impact(label),
            "Stockout_Risk_Flag_Planner",
            "Reason_Code",
            "Modified_By_User_ID",
            "Modification_Timestamp",
        )
        .orderBy(F.col("Impact_Days_Planner").desc_nulls_last(), *KEY)
        .limit(n)
    )
