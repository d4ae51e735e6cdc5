from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from veracast.operators import accuracy, baselines, horizons
from veracast.operators.alerts import drift_alerts, with_alert_text
from veracast.operators.value_added import forecast_value_added

ROWS = "sku_id string, algo_name string, date_month date, actual_qty double, forecast_qty double"
ANCHOR = dt.date(2024, 12, 1)


def month(ago: int) -> dt.date:
    index = ANCHOR.year * 12 + ANCHOR.month - 1 - ago
    return dt.date(index // 12, index % 12 + 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def kpis(spark, pairs, window=12):
    rows = [("P", "A", month(i), a, f) for i, (a, f) in enumerate(pairs)]
    return accuracy.performance(frame(spark, rows), ANCHOR, [window]).first()


def test_golden_kpis(spark):
    got = kpis(spark, [(100.0, 90.0), (0.0, 10.0), (50.0, 60.0), (0.0, 0.0), (None, 40.0)])
    assert got.mape == pytest.approx(15.0)
    assert got.wape == pytest.approx(20.0)
    assert got.mae == pytest.approx(7.5)
    assert got.rmse == pytest.approx(math.sqrt(75))
    assert got.bias == pytest.approx(-2.5)
    assert got.tracking_signal == pytest.approx(-10 / 7.5)
    assert got.smape == pytest.approx((20 / 190 + 2 + 20 / 110) / 3 * 100)
    assert got.n_obs == 5
    assert got.theils_u is None


def test_error_detail_rows(spark):
    rows = [("P", "A", month(0), 0.0, 0.0), ("P", "A", month(1), -50.0, 10.0)]
    detail = accuracy.error_detail(frame(spark, rows), ANCHOR, [3]).orderBy("date_month").collect()
    negative, zero = detail
    # The percentage error divides by the signed actual.
    assert (negative.signed_error, negative.ape) == (-60.0, -1.2)
    assert (zero.is_zero_actual, zero.ape, zero.abs_error) == (True, None, 0.0)
    assert "smape_element" not in detail[0].asDict()


def test_only_future_or_null_actuals_give_nulls_not_errors(spark):
    got = kpis(spark, [(None, 5.0), (None, 6.0)])
    assert (got.mape, got.wape, got.rmse, got.tracking_signal, got.n_obs) == (None, None, None, 0.0, 2)


def test_zero_sales_total_gives_null_wape(spark):
    got = kpis(spark, [(0.0, 5.0), (0.0, 6.0)])
    assert got.wape is None and got.mae == pytest.approx(5.5)


def test_window_bounds_are_inclusive_and_exclude_the_future(spark):
    rows = [("P", "A", month(i), 1.0, 1.0) for i in range(-2, 15)]
    df = frame(spark, rows)
    counted = {
        r.analytical_window_months: r.n
        for r in horizons.assign_windows(df, ANCHOR, [12, 1, 6, 3])
        .groupBy("analytical_window_months").count().withColumnRenamed("count", "n").collect()
    }
    assert counted == {1: 1, 3: 3, 6: 6, 12: 12}
    assert horizons.window_filter(df, ANCHOR, 6).count() == 6


def test_anchor_modes(spark):
    rows = [("P", "A", month(0), None, 1.0), ("P", "A", month(2), 3.0, 1.0)]
    df = frame(spark, rows)
    assert horizons.max_month(df, "data").first()[0] == month(0)
    assert horizons.max_month(df, "actuals").first()[0] == month(2)
    with pytest.raises(ValueError):
        horizons.max_month(df, "newest")


quantities = st.one_of(st.none(), st.integers(0, 60).map(float))
histories = st.lists(
    st.tuples(
        st.sampled_from(["P1", "P2"]), st.sampled_from(["A", "B"]), st.integers(-2, 26),
        quantities, st.integers(0, 60).map(float),
    ),
    min_size=1, max_size=60, unique_by=lambda r: r[:3],
)


def rounded(df):
    return {
        tuple(r[:3]): tuple(None if v is None else round(v, 8) for v in r[3:]) for r in df.collect()
    }


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(histories)
def test_one_pass_equals_loop_and_running_frame(spark, rows):
    df = frame(spark, [(p, a, month(ago), act, fc) for p, a, ago, act, fc in rows]).cache()
    one_pass = rounded(accuracy.performance(df, ANCHOR, range(1, 25)))
    assert one_pass == rounded(accuracy.performance_all_windows(df, ANCHOR, 24))
    some = {k: v for k, v in one_pass.items() if k[2] in (1, 3, 6, 12)}
    assert some == rounded(accuracy.performance_by_union(df, ANCHOR, [1, 3, 6, 12]))
    detail = accuracy.error_detail(df, ANCHOR, [1, 3, 6, 12])
    assert some == rounded(accuracy.performance_of_detail(detail))
    observed = {}
    for (product, algo, window), values in one_pass.items():
        smape, signal, n_obs = values[4], values[6], values[8]
        assert abs(signal) <= n_obs + 1e-6
        assert smape is None or 0 <= smape <= 200
        observed.setdefault((product, algo), []).append((window, n_obs))
    for cells in observed.values():
        counts = [n for _, n in sorted(cells)]
        assert counts == sorted(counts)


def test_running_frame_folds_several_rows_of_a_month(spark):
    rows = [("P", "A", month(0), 10.0, 8.0), ("P", "A", month(0), 20.0, 25.0), ("P", "A", month(4), 5.0, 5.0)]
    df = frame(spark, rows)
    assert rounded(accuracy.performance_all_windows(df, ANCHOR, 24)) == rounded(
        accuracy.performance(df, ANCHOR, range(1, 25))
    )


def test_theils_u_on_request(spark):
    months = spark.createDataFrame(
        [("P", month(2 - i), a) for i, a in enumerate([10.0, 14.0, 11.0])],
        "sku_id string, date_month date, actual_qty double",
    )
    rows = baselines.naive_forecast(months).selectExpr(
        "*", "'A' AS algo_name", "actual_qty + 1 AS forecast_qty"
    )
    got = accuracy.performance(rows, ANCHOR, [3], naive_column="forecast_naive").first()
    assert got.theils_u == pytest.approx(1 / math.sqrt((16 + 9) / 2))


PERF = (
    "product_id string, algo_name string, analytical_window_months int, mape double, "
    "wape double, rmse double, bias double, tracking_signal double, smape double, n_obs bigint"
)


def perf(spark, *rows):
    return spark.createDataFrame(
        [(p, a, 3, mape, wape, 1.0, 0.5, ts, mape, n) for p, a, mape, wape, ts, n in rows], PERF
    )


def test_best_algorithm_ignores_missing_metric_and_breaks_ties_by_name(spark):
    df = perf(
        spark,
        ("P", "B", 10.0, 9.0, 0.0, 3), ("P", "A", 10.0 + 1e-13, 9.0, 0.0, 3),
        ("P", "0", None, None, 0.0, 3), ("Q", "Z", None, None, 0.0, 1),
    )
    best = {r.product_id: r.algo_name for r in accuracy.best_algorithm(df, "mape").collect()}
    assert best == {"P": "A", "Q": "Z"}


def test_leaderboard(spark):
    df = perf(
        spark,
        ("P", "A", 10.0, 1.0, 0.0, 3), ("Q", "A", 20.0, 3.0, 0.0, 3), ("P", "B", 15.0, 1.0, 0.0, 3),
        ("P", "C", 16.0, 1.0, 0.0, 3), ("P", "D", None, 1.0, 0.0, 3),
    )
    for shortcut in (False, True):
        board = accuracy.leaderboard(df, one_row_per_product=shortcut)
        rows = {r.algo_name: r for r in board.collect()}
        assert {a: r.rank_mape for a, r in rows.items()} == {"A": 1, "B": 1, "C": 2, "D": 3}
        assert rows["A"].count_products == 2
        assert {r.segment_abcxyz for r in rows.values()} == {"ALL"}
    custom = df.withColumnRenamed("product_id", "product_id").selectExpr("*", "product_id AS zone")
    assert {r.segment_abcxyz for r in accuracy.leaderboard(custom, "zone").collect()} == {"P", "Q"}


def test_value_added_flags(spark):
    df = perf(
        spark,
        ("gain", "A", 1.0, 20.0, 0.0, 7), ("gain", "B", 1.0, 30.0, 0.0, 8), ("gain", "Expert_DP", 1.0, 15.0, 0.0, 9),
        ("gain", "NAIVE", 1.0, 40.0, 0.0, 9), ("same", "A", 1.0, 20.0, 0.0, 1), ("same", "Planner", 1.0, 20.00001, 0.0, 1),
        ("loss", "A", 1.0, 20.0, 0.0, 1), ("loss", "planner", 1.0, 25.0, 0.0, 1), ("loss", "expert_dp", 1.0, 29.0, 0.0, 1),
        ("none", "A", 1.0, 20.0, 0.0, 1), ("humans", "planner", 1.0, 1.0, 0.0, 1),
    )
    got = {r.product_id: r for r in forecast_value_added(df).collect()}
    assert {p: r.fva_flag for p, r in got.items()} == {
        "gain": "Positive", "same": "Neutral", "loss": "Negative", "none": "Unknown",
    }
    assert (got["gain"].naive_error_metric, got["gain"].n_obs, got["gain"].fva_value) == (40.0, 7, 5.0)
    assert got["loss"].planner_error_metric == 25.0
    only_humans = forecast_value_added(df.filter("algo_name = 'planner'"))
    assert only_humans.isEmpty() and "fva_flag" in only_humans.columns


def test_alert_limits_and_text(spark):
    df = perf(
        spark,
        ("P", "ok", 29.99, 1.0, 5.99, 9), ("P", "mape", 30.0 - 1e-12, 1.0, 0.0, 9), ("P", "drift", 1.0, 1.0, -6.0, 9),
        ("P", "severe", 1.0, 1.0, 9.0, 9), ("P", "quiet", None, 1.0, 2.0, 9), ("P", "blind", None, 1.0, -7.125, 9),
    )
    raised = with_alert_text(drift_alerts(df))
    got = {r.algo_name: r for r in raised.collect()}
    assert {a: r.severity for a, r in got.items()} == {
        "mape": "HIGH", "drift": "HIGH", "severe": "CRITICAL", "blind": "HIGH",
    }
    text = got["blind"].recommendation_text
    assert "Alerte de niveau HIGH" in text and "l'algorithme blind" in text and "à -7.13." in text
    assert text.count("\n- ") == 3
    assert got["blind"].model_source == "fallback"


def test_baselines(spark):
    months = spark.createDataFrame(
        [("P", month(40 - i), float(10 + 2 * i)) for i in range(20)] + [("S", month(1), 5.0)],
        "sku_id string, date_month date, actual_qty double",
    )
    trend = baselines.trend_forecast(months).collect()
    assert len(trend) == 6 and {r.sku_id for r in trend} == {"P"}
    assert all(r.forecast_trend == pytest.approx(r.actual_qty) for r in trend)
    moving = baselines.moving_average_forecast(months).filter("sku_id = 'P'").orderBy("date_month").collect()
    assert moving[0].forecast_moving_average is None
    assert moving[5].forecast_moving_average == pytest.approx((14 + 16 + 18) / 3)
    rows = frame(spark, [("P", a, month(m), float(m), 1.0) for a in "AB" for m in (5, 3)])
    assert [tuple(r) for r in baselines.naive_rows(rows).collect()] == [
        ("P", "naive", month(3), 3.0, 5.0)
    ]
