from __future__ import annotations

import pytest

from veracast.operators import leadtime

PERF = (
    "product_id string, algo_name string, analytical_window_months int, mape double, "
    "wape double, rmse double, smape double"
)


def perf(spark, rows):
    return spark.createDataFrame([(p, "A", w, 1.0, wape, 2.0, s) for p, w, wape, s in rows], PERF)


def test_levels_clamp_and_default(spark):
    df = perf(
        spark,
        [("a", 1, 14.9, 1.0), ("b", 1, 15.0, 1.0), ("c", 1, 25.0, 1.0), ("d", 1, 35.0, 1.0),
         ("e", 1, 250.0, 1.0), ("f", 1, None, 1.0), ("g", 1, -5.0, 1.0)],
    )
    got = {r.product_id: r for r in leadtime.leadtime_impact(df).collect()}
    assert {p: r.risk_severity for p, r in got.items()} == {
        "a": "LOW", "b": "MEDIUM", "c": "HIGH", "d": "CRITICAL", "e": "CRITICAL", "f": "LOW", "g": "LOW",
    }
    assert {p for p, r in got.items() if r.stockout_risk_flag} == {"c", "d", "e"}
    assert (got["e"].volatility_metric_value, got["f"].volatility_metric_value) == (1.0, 0.0)
    assert (got["a"].lead_time_days, got["a"].lead_time_days_source) == (45, "default")
    assert got["a"].safety_stock_days_required == pytest.approx(6.71)  # 6.705 half up
    assert got["g"].volatility_metric_value == 0.0


def test_master_lead_time(spark):
    master = spark.createDataFrame([("a", 30), ("b", None)], "product_id string, lead_time_days int")
    df = perf(spark, [("a", 1, 50.0, 1.0), ("b", 1, 50.0, 1.0), ("c", 1, 50.0, 1.0)])
    got = {
        r.product_id: (r.lead_time_days, r.lead_time_days_source, r.safety_stock_days_required)
        for r in leadtime.leadtime_impact(df, master).collect()
    }
    assert got == {
        "a": (30, "masterdata", 15.0), "b": (45, "default", 22.5), "c": (45, "default", 22.5),
    }


def test_metric_preference(spark):
    df = perf(spark, [("a", 1, 50.0, 1.0)])
    rmse = leadtime.leadtime_impact(df.drop("wape")).first()
    assert (rmse.volatility_metric_name, rmse.volatility_metric_value) == ("rmse", 1.0)
    none = leadtime.leadtime_impact(df.drop("wape", "rmse")).first()
    assert (none.volatility_metric_name, none.volatility_metric_value) == ("none", 0.0)


def correlate(spark, rows, days):
    df = perf(spark, rows)
    master = spark.createDataFrame(days, "product_id string, lead_time_days int")
    impact = leadtime.leadtime_impact(df, master, keep_metrics=True)
    return {
        (r.analytical_window_months, r.corr_metric_name): (r.correlation_value, r.n_products)
        for r in leadtime.leadtime_correlation(impact).collect()
    }


def test_correlation(spark):
    rows = [(p, 1, 10.0 * i, -5.0 * i) for i, p in enumerate("abcd", 1)]
    rows += [("a", 3, 1.0, 1.0), ("b", 3, 2.0, 2.0)]
    got = correlate(spark, rows, [("a", 10), ("b", 20), ("c", 30), ("d", 40)])
    assert got[1, "wape"] == (pytest.approx(1.0), 4)
    assert got[1, "smape"] == (pytest.approx(-1.0), 4)
    assert got[3, "wape"] == (None, 2) and got[3, "smape"] == (None, 2)


def test_correlation_is_null_for_constant_lead_time_or_few_pairs(spark):
    rows = [("a", 1, 1.0, None), ("b", 1, 2.0, None), ("c", 1, 4.0, 1.0)]
    got = correlate(spark, rows, [])
    assert got == {(1, "wape"): (None, 3), (1, "smape"): (None, 3)}
