"""Fitted models per product, reported with what another reader needs to check them.

Spark groups, sorts and splits each product's series; Python gets batches of train arrays and returns
weights, errors and chosen forms. The errors of reported weights are worked out once more by column
functions, which share no code with the fit.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veracast.config import Settings
from veracast.functions.arima import choose_order
from veracast.functions.forecasters import additive_errors, fitted_additive
from veracast.functions.numeric import ratio
from veracast.functions.statespace import choose_form
from veracast.operators.backtest import train_series
from veracast.shipping import ship


def _reported(series: DataFrame, work, schema: str) -> DataFrame:
    """(Material_ID, n_train, ...) of ``work(list of train arrays) -> list of rows``."""
    ship(series.sparkSession)

    def run(batch: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in schema.split(", ")]
        if batch.empty:
            return pd.DataFrame({name: [] for name in names})
        train = [np.asarray(values, dtype=float) for values in batch]
        return pd.DataFrame(work(train), columns=names)

    found = F.pandas_udf(run, schema)(F.col("train"))
    return series.select("Material_ID", F.size("train").alias("n_train"), "train", found.alias("fit"))


def additive_error(train: Column, alpha: Column, beta: Column, gamma: Column, season: int) -> Column:
    """Squared one-step error of additive Holt-Winters with these weights, by column functions."""

    def mean(first: int) -> Column:
        year = F.slice(train, first, season)
        return F.aggregate(year, F.lit(0.0), lambda a, x: a + x) / season

    slope = (mean(season + 1) - mean(1)) / season
    level = mean(1) - slope * (season + 1) / 2
    start = F.struct(
        level.alias("level"),
        slope.alias("slope"),
        F.transform(
            F.slice(train, 1, season), lambda x, i: x - (level + slope * (i + 1))
        ).alias("cycle"),
        F.lit(0.0).alias("error"),
    )

    def step(state: Column, row: Column) -> Column:
        slot = row["t"] % season
        base = state["level"] + state["slope"]
        e = row["y"] - base - F.element_at(state["cycle"], slot + 1)
        cycle = F.transform(
            state["cycle"], lambda c, i: F.when(i == slot, c + gamma * (1 - alpha) * e).otherwise(c)
        )
        return F.struct(
            (base + alpha * e).alias("level"),
            (state["slope"] + beta * alpha * e).alias("slope"),
            cycle.alias("cycle"),
            (state["error"] + e * e).alias("error"),
        )

    rows = F.transform(train, lambda y, t: F.struct(y.alias("y"), t.alias("t")))
    return F.aggregate(rows, start, step, lambda state: state["error"])


def holt_winters_fit(sales: DataFrame, settings: Settings = Settings(), one_row_per_date: bool = False) -> DataFrame:
    """Material_ID, n_train, alpha, beta, gamma, sse of additive Holt-Winters per product.

    Weights lie within 0 and 1 and have six decimals; ``sse`` is the squared one-step error over the
    train rows with exactly these. Products under two seasons of train rows are left out.
    """
    season = settings.season_months
    series = train_series(sales, settings, one_row_per_date).where(F.size("train") >= 2 * season)

    def work(train: Sequence[np.ndarray]) -> list[tuple]:
        weights, errors = fitted_additive(train, season)
        return [(*w, e) for w, e in zip(weights.tolist(), errors.tolist())]

    schema = "alpha double, beta double, gamma double, sse double"
    return _reported(series, work, schema).select("Material_ID", "n_train", "fit.*")


def holt_winters_proof(
    sales: DataFrame,
    grid: Sequence[Sequence[float]],
    settings: Settings = Settings(),
    one_row_per_date: bool = False,
) -> DataFrame:
    """Per product: the least root mean squared error on ``grid``, and whether the fit stands.

    ``within_bounds``: weights between 0 and 1. ``error_confirmed``: column functions find the
    reported error. ``beats_grid``: no weights of the grid do better.
    """
    season = settings.season_months
    series = train_series(sales, settings, one_row_per_date).where(F.size("train") >= 2 * season)

    def work(train: Sequence[np.ndarray]) -> list[tuple]:
        weights, errors = fitted_additive(train, season)
        least = np.min([additive_errors(train, season, point) for point in product(*grid)], axis=0)
        return [(*w, e, g) for w, e, g in zip(weights.tolist(), errors.tolist(), least.tolist())]

    schema = "alpha double, beta double, gamma double, sse double, grid_sse double"
    fit = _reported(series, work, schema).select("Material_ID", "n_train", "train", "fit.*")
    weights = [F.col(c) for c in ("alpha", "beta", "gamma")]
    within = F.lit(True)
    for w in weights:
        within = within & w.between(0.0, 1.0)
    again = additive_error(F.col("train"), *weights, season)
    near = F.abs(again - F.col("sse")) <= 1e-9 * F.greatest(again, F.lit(1.0))
    return fit.select(
        "Material_ID",
        "n_train",
        F.sqrt(F.col("grid_sse") / F.col("n_train")).alias("grid_rmse"),
        within.alias("within_bounds"),
        near.alias("error_confirmed"),
        (F.col("sse") <= F.col("grid_sse") * (1 + 1e-9) + 1e-9).alias("beats_grid"),
    )


def ets_fit(sales: DataFrame, settings: Settings = Settings(), one_row_per_date: bool = False) -> DataFrame:
    """Material_ID, n_train, form, aicc, sse of the state-space form with the least AICc.

    A product that no form suits has an empty form and neither criterion nor error.
    """
    def work(train: Sequence[np.ndarray]) -> list[tuple]:
        forms, criterion, errors, _ = choose_form(train, settings.season_months, 1)
        return [
            (form, c if form else None, e if form else None)
            for form, c, e in zip(forms, criterion.tolist(), errors.tolist())
        ]

    series = train_series(sales, settings, one_row_per_date)
    return _reported(series, work, "form string, aicc double, sse double").select(
        "Material_ID", "n_train", "fit.*"
    )


def arima_orders(sales: DataFrame, settings: Settings = Settings(), one_row_per_date: bool = False) -> DataFrame:
    """Material_ID, n_train, p, d, q chosen by unit-root test and AICc; null for short series."""

    def work(train: Sequence[np.ndarray]) -> list[tuple]:
        return [order or (None, None, None) for order in choose_order(train, 1)[0]]

    series = train_series(sales, settings, one_row_per_date)
    return _reported(series, work, "p double, d double, q double").select(
        "Material_ID", "n_train", *[F.col(f"fit.{c}").cast("int").alias(c) for c in "pdq"]
    )


def ar2_coefficients(monthly: DataFrame) -> DataFrame:
    """sku_id, n_rows, constant, ar1, ar2: least squares on the two rows before, by sums alone.

    Rows with a null among the three are left out. Null where the two lags are collinear or a
    product has no such rows.
    """
    order = Window.partitionBy("sku_id").orderBy("date_month")
    rows = monthly.select(
        "sku_id",
        F.col("actual_qty").cast("double").alias("y"),
        F.lag("actual_qty", 1).over(order).cast("double").alias("a"),
        F.lag("actual_qty", 2).over(order).cast("double").alias("b"),
    ).where("y IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL")
    sums = rows.groupBy("sku_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.avg(c).alias(f"m_{c}") for c in "yab"],
        F.var_pop("a").alias("aa"),
        F.var_pop("b").alias("bb"),
        F.covar_pop("a", "b").alias("ab"),
        F.covar_pop("a", "y").alias("ay"),
        F.covar_pop("b", "y").alias("by"),
    )
    spread = F.col("aa") * F.col("bb") - F.col("ab") * F.col("ab")
    known = spread > 1e-9 * F.col("aa") * F.col("bb")
    ar1 = ratio(F.col("ay") * F.col("bb") - F.col("by") * F.col("ab"), F.when(known, spread))
    ar2 = ratio(F.col("by") * F.col("aa") - F.col("ay") * F.col("ab"), F.when(known, spread))
    return sums.select(
        "sku_id",
        "n_rows",
        (F.col("m_y") - ar1 * F.col("m_a") - ar2 * F.col("m_b")).alias("constant"),
        ar1.alias("ar1"),
        ar2.alias("ar2"),
    )
