from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

from veracast.functions.forecasters import holt_winters, last_value, per_series, train_mean
from veracast.operators import backtest

SALES = "Material_ID string, Sales_Date date, Quantity_Sold double"


def month(i: int) -> dt.date:
    return dt.date(2020 + i // 12, i % 12 + 1, 1)


def series(name, values):
    return [(name, month(i), float(v)) for i, v in enumerate(values)]


def test_holt_winters_reproduces_trend_and_season():
    t = np.arange(60)
    season = np.array([5, -3, 0, 8, -6, 2, 1, -4, 7, -2, -5, -3])
    lines = [50 + 1.5 * t + season[t % 12], 300 - 2.0 * t + 3 * season[t % 12], 20 + 0.0 * t]
    train = [y[:-6] for y in lines]
    forecast = holt_winters(12)(train, 6)
    assert forecast == pytest.approx(np.stack([y[-6:] for y in lines]), abs=1e-6)


def test_holt_winters_mixed_lengths_and_short_series():
    rng = np.random.default_rng(1)
    train = [rng.random(30) * 10, np.arange(13.0), rng.random(45) * 10, rng.random(30) * 10]
    together = holt_winters(12)(train, 6)
    assert together.shape == (4, 6) and np.isfinite(together).all()
    alone = np.vstack([holt_winters(12)([y], 6) for y in train])
    assert together == pytest.approx(alone)
    assert together[1] == pytest.approx([6.0] * 6)


def test_failing_model_uses_the_train_mean():
    def fussy(y, horizon):
        if y.sum() > 10:
            raise RuntimeError("no fit")
        return np.full(horizon, -1.0)

    got = per_series(fussy)([np.array([1.0, 2.0]), np.array([10.0, 20.0])], 2)
    assert got.tolist() == [[-1.0, -1.0], [15.0, 15.0]]


def test_holdout_rows(spark):
    rows = series("long", range(1, 20)) + series("short", range(17)) + series("edge", range(18))
    df = spark.createDataFrame(rows, SALES).repartition(5)
    models = {"Forecast_Mean": train_mean, "Forecast_Naive": last_value, "Forecast_Neg": lambda t, h: -train_mean(t, h)}
    got = backtest.holdout_forecasts(df, models).orderBy("Material_ID", "Sales_Date").collect()
    assert [r.Material_ID for r in got] == ["edge"] * 6 + ["long"] * 6
    long = got[6:]
    assert [r.Actual_Qty for r in long] == [14.0, 15.0, 16.0, 17.0, 18.0, 19.0]
    assert long[0].Sales_Date == month(13)
    assert {(r.Forecast_Mean, r.Forecast_Naive, r.Forecast_Neg) for r in long} == {(7.0, 13.0, 0.0)}


def test_many_rows_of_a_day_fold_into_one_point(spark):
    hot = spark.range(30_000).selectExpr(
        "'hot' AS Material_ID",
        "add_months(DATE'2020-01-01', cast(id % 20 as int)) AS Sales_Date",
        "1.0D AS Quantity_Sold",
    )
    got = backtest.holdout_forecasts(hot, {"Forecast_Mean": train_mean}).collect()
    assert len(got) == 6 and {r.Actual_Qty for r in got} == {1500.0}
    assert {r.Forecast_Mean for r in got} == {1500.0}


def evaluation(spark, rows):
    holdout = spark.createDataFrame(
        [(m, month(0), a, p) for m, a, p, _, _ in rows],
        "Material_ID string, Sales_Date date, Actual_Qty double, Forecast_Prophet double",
    ).selectExpr("*", "Forecast_Prophet AS Forecast_HoltWinters")
    planner = spark.createDataFrame(
        [(m, month(0), 1.0, q, "u", dt.datetime(2020, 1, 1), "r") for m, _, _, q, _ in rows if q is not None],
        "Material_ID string, Sales_Date date, System_Forecast_Qty double, Planner_Forecast_Qty double, "
        "Modified_By_User_ID string, Modification_Timestamp timestamp, Reason_Code string",
    )
    master = spark.createDataFrame(
        [(m, lt, 10) for m, _, _, _, lt in rows if lt is not None],
        "Material_ID string, Mfg_LeadTime_Days bigint, Proc_LeadTime_Days bigint",
    )
    return backtest.evaluate_backtest(holdout, planner, master)


def test_impact_and_flags(spark):
    from veracast.schemas import conform

    df = evaluation(
        spark,
        [("a", 100.0, 150.0, 70.0, 20), ("b", 0.0, 5.0, 3.0, 20), ("c", 100.0, 80.0, None, 20),
         ("d", 100.0, 79.0, 90.0, None)],
    )
    got = {r.Material_ID: r for r in conform(df, "backtest_evaluation").collect()}
    a = got["a"]
    assert (a.Forecast_Error_Pct_Planner, a.Safety_Stock_Impact_Days_Planner) == pytest.approx((-0.3, 9.0))
    assert (a.Stockout_Risk_Flag_Planner, a.Stockout_Risk_Flag_Prophet) == ("HIGH", "LOW")
    assert a.Total_Lead_Time_Days == 30 and a.Safety_Stock_Impact_Days_Prophet == pytest.approx(15.0)
    assert got["b"].Forecast_Error_Pct_Planner == 0.0
    assert got["c"].Stockout_Risk_Flag_Planner == "LOW" and got["c"].Forecast_Error_Pct_Planner is None
    # Exactly 20 % under is not yet a stock-out risk.
    assert got["c"].Stockout_Risk_Flag_Prophet == "LOW" and got["d"].Stockout_Risk_Flag_Prophet == "HIGH"
    assert got["d"].Safety_Stock_Impact_Days_Planner is None


def test_top_risks_are_high_only_sorted_and_limited(spark):
    rows = [(f"m{i:03d}", 100.0, 100.0, 79.0 - i % 40, 20) for i in range(120)]
    rows.append(("low", 100.0, 100.0, 95.0, 90))
    top = backtest.top_stockout_risks(evaluation(spark, rows), n=100).collect()
    impacts = [r.Impact_Days_Planner for r in top]
    assert len(top) == 100 and impacts == sorted(impacts, reverse=True)
    assert "low" not in {r.Material_ID for r in top}
    ties = [r.Material_ID for r in top if r.Impact_Days_Planner == impacts[0]]
    assert ties == sorted(ties) and len(ties) == 3
