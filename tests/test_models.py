"""Fitted and seasonal models: known series, plain recomputation, odd histories."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from itertools import product

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veracast.config import Settings
from veracast.functions import arima, loess, statespace
from veracast.functions.forecasters import additive_errors, fitted_additive
from veracast.functions.search import bounded_minimum
from veracast.operators import backtest, fits, origins, seasonal
from veracast.plans.catalog import PROOF_GRID

MONTHLY = "sku_id string, date_month date, actual_qty double"
SALES = "Material_ID string, Sales_Date date, Quantity_Sold double"
SEASON = np.array([5, -3, 0, 8, -6, 2, 1, -4, 7, -2, -5, -3], dtype=float)


def month(i: int) -> dt.date:
    return dt.date(2010 + i // 12, i % 12 + 1, 1)


def frame(spark, **products):
    """Products by name; a history is values by month number, or values from month 0 on."""
    rows = []
    for name, history in products.items():
        values = history if isinstance(history, dict) else dict(enumerate(history))
        rows += [(name, month(i), None if v is None else float(v)) for i, v in values.items()]
    return spark.createDataFrame(rows, MONTHLY).repartition(3)


# -- search ------------------------------------------------------------------------------


def test_search_finds_optima_inside_and_at_bounds():
    target = np.array([[0.37, 0.8], [0.0, 1.0], [1.0, 0.123]])

    def bowl(w):
        return ((w - target) ** 2 @ np.array([1.0, 3.0])) + 5

    at, value = bounded_minimum(bowl, 3, [(0.1, 0.5, 0.9)] * 2, [(0.0, 1.0)] * 2)
    assert at == pytest.approx(target, abs=1e-3) and value == pytest.approx([5, 5, 5], abs=1e-5)


def test_search_escapes_the_basin_of_the_best_start():
    def two_basins(w):
        x = w[:, 0]
        return np.minimum((x - 0.2) ** 2 + 0.1, 40 * (x - 0.87) ** 2)

    at, _ = bounded_minimum(two_basins, 2, [(0.0, 0.2, 0.4, 0.6, 0.8, 1.0)], [(0.0, 1.0)], starts=6)
    assert at[:, 0] == pytest.approx([0.87, 0.87], abs=1e-3)


# -- Holt-Winters ------------------------------------------------------------------------


def test_fit_finds_a_basin_with_a_middling_trend_weight():
    sold = [0, 37, 49, 20, 0, 47, 23, 23, 0, 26, 24, 66, 8, 0, 0, 11, 0, 0, 59, 64, 0, 34, 43, 21, 41,
            19, 50, 8, 53]
    train = [np.array(sold, dtype=float)]
    _, error = fitted_additive(train, 12)
    least = min(additive_errors(train, 12, point)[0] for point in product(*PROOF_GRID))
    assert error[0] <= least


def test_fit_is_never_worse_than_a_fine_grid():
    rng = np.random.default_rng(2)
    train = [rng.random(n) * 50 for n in (24, 24, 40, 61)] + [np.zeros(30), np.arange(48.0)]
    weights, errors = fitted_additive(train, 12)
    assert ((weights >= 0) & (weights <= 1)).all()
    steps = np.linspace(0, 1, 11)
    grid = [(a, b, c) for a in steps for b in steps for c in steps]
    least = np.min([additive_errors(train, 12, point) for point in grid], axis=0)
    assert (errors <= least * (1 + 1e-9) + 1e-9).all()
    for series, w, e in zip(train, weights, errors):
        assert additive_errors([series], 12, w)[0] == pytest.approx(e)


def test_reported_error_is_confirmed_by_columns(spark):
    rng = np.random.default_rng(4)
    rows = [(f"p{k}", month(i), float(rng.integers(0, 90))) for k in range(5) for i in range(30 + 7 * k)]
    rows += [("short", month(i), 1.0) for i in range(29)]
    proof = fits.holt_winters_proof(spark.createDataFrame(rows, SALES), ((0.2, 1.0), (0.1,), (0.3,)))
    found = {r.Material_ID: r for r in proof.collect()}
    assert sorted(found) == [f"p{k}" for k in range(5)]
    assert all(r.within_bounds and r.error_confirmed and r.beats_grid for r in found.values())
    assert [found[f"p{k}"].n_train for k in range(5)] == [24 + 7 * k for k in range(5)]


# -- state space -------------------------------------------------------------------------


def generated(form: str, rng, n: int = 144) -> np.ndarray:
    phi, level, slope = 0.9 if form[1] == "D" else 1.0, 200.0, {"N": 0.0, "A": 4.0, "D": 15.0}[form[1]]
    swing = np.array([30, -20, 10, 40, -35, 5, -15, 25, -30, 15, -10, -15.0]) * 2
    cycle = {"N": np.zeros(12), "A": swing.copy(), "M": 1 + swing / 200}[form[2]]
    out = []
    for t in range(n):
        base = level + phi * slope
        s = cycle[t % 12]
        mu = base * s if form[2] == "M" else base + s
        e = rng.normal() * (8 if form[0] == "A" else (0.1 if form[2] == "N" else 0.04) * mu)
        out.append(mu + e)
        per_level = e / s if form[2] == "M" else e
        if form[2] != "N":
            cycle[t % 12] = s + 0.1 * (e / base if form[2] == "M" else e)
        level = base + 0.3 * per_level
        slope = phi * slope + 0.03 * per_level if form[1] != "N" else 0.0
    return np.array(out)


def test_generated_series_recover_their_form():
    rng = np.random.default_rng(7)
    made = [(form, generated(form, rng)) for form in statespace.FORMS for _ in range(20)]
    made = [(form, y) for form, y in made if (y > 0).all()]
    chosen, criterion, errors, _ = statespace.choose_form([y for _, y in made], 12, 6)
    assert np.isfinite(criterion).all() and np.isfinite(errors).all()
    for form in statespace.FORMS:
        found = Counter(c for c, (f, _) in zip(chosen, made) if f == form)
        assert found.most_common(1)[0][0] == form, found


def test_forms_of_short_flat_and_zero_series():
    series = [np.arange(1.0, 14.0), np.zeros(40), np.full(30, 7.0), np.r_[0.0, np.arange(35.0)]]
    chosen, _, _, ahead = statespace.choose_form(series, 12, 4)
    assert ahead[0] == pytest.approx([14, 15, 16, 17], rel=0.1)
    assert ahead[1] == pytest.approx([0] * 4, abs=1e-9) and ahead[2] == pytest.approx([7] * 4)
    assert all(f[2] == "N" for f in chosen[:1]) and "M" not in chosen[3]


def test_many_series_fit_as_one_by_one():
    rng = np.random.default_rng(9)
    series = [rng.random(n) * 20 + 5 for n in (30, 30, 44, 13)]
    together = statespace.choose_form(series, 12, 3)
    alone = [statespace.choose_form([y], 12, 3) for y in series]
    assert together[0] == [a[0][0] for a in alone]
    assert together[3] == pytest.approx(np.vstack([a[3] for a in alone]))


# -- ARIMA -------------------------------------------------------------------------------


def process(rng, ar=(), ma=(), d=0, level=10.0, n=400):
    e = rng.normal(size=n + 100)
    z = np.zeros(n + 100)
    for t in range(3, n + 100):
        z[t] = sum(a * z[t - i - 1] for i, a in enumerate(ar)) + e[t]
        z[t] += sum(m * e[t - i - 1] for i, m in enumerate(ma))
    z = z[100:] + (level if not d else 0)
    for _ in range(d):
        z = z.cumsum()
    return z


@pytest.mark.parametrize("ar, ma", [((0.7,), ()), ((0.5, 0.3), ()), ((), (0.6,)), ((0.6,), (0.4,))])
def test_known_processes_are_recovered(ar, ma):
    """Coefficients of the true order within 0.05 on the mean of 40 series of 400 rows."""
    rng = np.random.default_rng(11)
    z = np.stack([process(rng, ar, ma) for _ in range(40)])
    first = 30
    e = arima.shocks(z, 26)
    x = np.concatenate([arima.lagged(z, len(ar), first), arima.lagged(e, len(ma), first)], axis=2)
    found, _ = arima.regressed(x, z[:, first:])
    assert found[:, 1:].mean(axis=0) == pytest.approx([*ar, *ma], abs=0.05)


def test_orders_and_differences_of_known_processes():
    rng = np.random.default_rng(12)
    for kind, want in [({"ar": (0.7,)}, (1, 0, 0)), ({}, (0, 0, 0)), ({"d": 1}, (0, 1, 0))]:
        chosen, _ = arima.choose_order([process(rng, **kind) for _ in range(40)], 1)
        assert Counter(chosen).most_common(1)[0][0] == want
    second = np.stack([process(rng, d=2) for _ in range(20)])
    assert (arima.n_differences(second) == 2).mean() >= 0.9


def test_arima_continues_a_line_and_odd_series():
    line = 3.0 + 2.0 * np.arange(60)
    flat, short = np.full(40, 4.0), np.arange(12.0)
    chosen, ahead = arima.choose_order([line, flat, short], 3)
    assert ahead[0] == pytest.approx([123, 125, 127], rel=1e-6)
    assert ahead[1] == pytest.approx([4, 4, 4]) and chosen[2] is None
    assert ahead[2] == pytest.approx([5.5] * 3)


def test_ar2_coefficients_by_sums(spark):
    rng = np.random.default_rng(13)
    y = process(rng, (0.5, 0.3), n=90)
    gaps = [*y[:40], None, *y[41:]]
    found = {r.sku_id: r for r in fits.ar2_coefficients(frame(spark, a=y, b=gaps, c=[1.0] * 9, d=[2.0])).collect()}
    want, _ = arima.autoregression(y[None], 2)
    assert [found["a"].constant, found["a"].ar1, found["a"].ar2] == pytest.approx(want[0].tolist())
    assert found["a"].n_rows == 88 and found["b"].n_rows == 85
    assert found["c"].ar1 is None and "d" not in found


# -- loess -------------------------------------------------------------------------------


@given(
    st.lists(st.integers(-50, 50), min_size=5, max_size=40),
    st.integers(3, 50),
    st.data(),
)
@settings(max_examples=150, deadline=None)
def test_loess_equals_weighted_least_squares(values, span, data):
    y = np.array(values, dtype=float)
    robust = np.array(data.draw(st.lists(st.sampled_from([0.1, 0.5, 1.0]), min_size=len(y), max_size=len(y))))
    found = loess.loess(y[None], span, robust[None], -1, len(y))[0]
    x = np.arange(len(y), dtype=float)
    for place, value in zip(range(-1, len(y) + 1), found):
        away = np.abs(x - place)
        reach = np.sort(away)[min(span, len(y)) - 1] * max(1.0, span / len(y))
        w = np.clip(1 - (away / max(reach * 1.000001, 1e-9)) ** 3, 0, None) ** 3 * robust
        if (w > 0).sum() < 2:
            continue
        root = np.sqrt(w)
        full = np.stack([np.ones_like(x), x - place], axis=1)
        fit, *_ = np.linalg.lstsq(full * root[:, None], y * root, rcond=None)
        assert value == pytest.approx(fit[0], abs=1e-5)


def test_stlf_is_exact_on_trend_and_season():
    t = np.arange(80.0)
    y = np.stack([50 + 1.5 * t + SEASON[np.arange(80) % 12], 300 - 2 * t + 3 * SEASON[np.arange(80) % 12]])
    trend, season = loess.decomposed(y, 12)
    assert trend + season == pytest.approx(y, abs=1e-8)
    assert season[0] == pytest.approx((SEASON - SEASON.mean())[np.arange(80) % 12], abs=1e-8)
    assert loess.stlf()([*y[:, :-6]], 6) == pytest.approx(y[:, -6:], abs=1e-6)


def test_robust_weights_ignore_an_outlier():
    t = np.arange(72.0)
    clean = 100 + t + 2 * SEASON[np.arange(72) % 12]
    spoilt = clean + np.random.default_rng(1).normal(size=72) * 0.1
    spoilt[30] += 500
    robust, plain = (loess.decomposed(spoilt[None], 12, r)[0][0] for r in (True, False))
    assert np.abs(robust - 100 - t - 2 * SEASON.mean()).max() < 1
    assert np.abs(plain - 100 - t - 2 * SEASON.mean()).max() > 10
    assert loess.stlf()([np.arange(20.0)], 2) == pytest.approx(np.full((1, 2), 9.5))


# -- seasonal baselines by columns -------------------------------------------------------


def test_tslm_equals_least_squares_with_dummies(spark):
    rng = np.random.default_rng(21)
    histories = {f"p{k}": rng.integers(0, 200, 30 + 11 * k).tolist() for k in range(4)}
    gaps = {i: v for i, v in enumerate(rng.integers(0, 99, 60).tolist()) if i % 7}
    rows = seasonal.tslm_forecast(frame(spark, **histories, gaps=gaps)).collect()
    for name, history in [*histories.items(), ("gaps", gaps)]:
        values = history if isinstance(history, dict) else dict(enumerate(history))
        at = np.array(sorted(values), dtype=float)
        y = np.array([values[int(i)] for i in at], dtype=float)
        full = np.stack([at] + [(at % 12 == s).astype(float) for s in range(12)], axis=1)
        fit, *_ = np.linalg.lstsq(full[:-6], y[:-6], rcond=None)
        got = sorted((r.date_month, r.forecast_tslm) for r in rows if r.sku_id == name)
        assert [g for _, g in got] == pytest.approx(np.maximum(full[-6:] @ fit, 0).tolist(), abs=1e-6)


def test_tslm_singular_seasons(spark):
    once = {i: 10.0 + i for i in range(18)}  # 12 train rows: no calendar month twice
    unseen = {i: 5.0 + 2 * i for i in range(40) if i % 12 != 11 or i >= 34}
    found = {}
    for r in seasonal.tslm_forecast(frame(spark, once=once, unseen=unseen, short=range(17))).collect():
        found[r.sku_id, (r.date_month.year - 2010) * 12 + r.date_month.month - 1] = r
    assert {k[0] for k in found} == {"once", "unseen"}
    assert [found["once", i].tslm_slope for i in range(12, 18)] == [0.0] * 6
    assert [found["once", i].forecast_tslm for i in range(12, 18)] == [10.0 + i - 12 for i in range(12, 18)]
    assert found["unseen", 35].forecast_tslm == pytest.approx(75.0)


def test_maws_on_ratio_seasons_gaps_and_short_series(spark):
    index = 1 + SEASON / 20
    index *= 12 / index.sum()
    seasonal_rows = 100 * np.tile(index, 5)
    gappy = {i: 50.0 for i in range(40) if i % 9}  # no 13 months in a row
    zero = {i: 0.0 for i in range(30)}
    rows = seasonal.maws_forecast(
        frame(spark, s=seasonal_rows, gappy=gappy, zero=zero, short=[8.0] * 18, tiny=[1.0] * 17)
    ).collect()
    by_name = {n: [r for r in rows if r.sku_id == n] for n in ("s", "gappy", "zero", "short", "tiny")}
    want = dict(zip(map(month, range(54, 60)), seasonal_rows[-6:]))
    assert {r.date_month: r.forecast_maws for r in by_name["s"]} == pytest.approx(want)
    assert {r.forecast_maws for r in by_name["gappy"]} == {50.0} and len(by_name["gappy"]) == 6
    assert {r.forecast_maws for r in by_name["zero"]} == {0.0}
    assert {(r.forecast_maws, r.maws_index) for r in by_name["short"]} == {(8.0, 1.0)}
    assert by_name["tiny"] == []


def test_seasonal_baselines_shuffle_once(spark):
    monthly = frame(spark, a=range(40))
    for forecast in (seasonal.tslm_forecast, seasonal.maws_forecast, origins.rolling_origins):
        plan = forecast(monthly)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(sku_id") == 1 and "Python" not in plan


# -- rolling origins ---------------------------------------------------------------------


def test_rolling_origins_equal_separate_holdouts(spark):
    rng = np.random.default_rng(31)
    histories = {f"p{k}": rng.integers(0, 99, n).tolist() for k, n in enumerate((18, 30, 47, 60, 17))}
    rows = origins.rolling_origins(frame(spark, **histories), 24, 6, 12).collect()
    found = {(r.sku_id, r.origin_month, r.steps): r for r in rows}
    assert len(found) == len(rows)
    models = {"Forecast_Mean": backtest.mean_column, "Forecast_Naive": backtest.last_column}
    n_checked = 0
    for cut in (0, 1, 5, 23):
        left = {name: h[: len(h) - cut] for name, h in histories.items()}
        sales = frame(spark, **left).toDF("Material_ID", "Sales_Date", "Quantity_Sold")
        for r in backtest.holdout_forecasts(sales, models, Settings()).collect():
            y = np.array(left[r.Material_ID][:-6], dtype=float)
            at = (r.Sales_Date.year - 2010) * 12 + r.Sales_Date.month - 1
            got = found[r.Material_ID, month(len(y) - 1), at - len(y) + 1]
            slope, intercept = np.polyfit(np.arange(len(y)), y, 1)
            assert (got.date_month, got.actual_qty) == (r.Sales_Date, r.Actual_Qty)
            assert (got.forecast_mean, got.forecast_naive) == pytest.approx(
                (r.Forecast_Mean, r.Forecast_Naive)
            )
            assert got.forecast_line == pytest.approx(max(0.0, intercept + slope * at), abs=1e-6)
            n_checked += 1
    assert n_checked == 6 * (4 + 3 + 3 + 2)
    assert {s for s, _, _ in found} == {"p0", "p1", "p2", "p3"}
    assert sum(s == "p3" for s, _, _ in found) == 24 * 6


def test_rolling_origins_with_nulls(spark):
    rows = origins.rolling_origins(frame(spark, a=[None] * 14 + [4.0, None, 6.0, 8.0, 1.0, 1.0]), 24, 6, 12)
    found = {(r.origin_month, r.steps): r for r in rows.collect()}
    assert {o for o, _ in found} == {month(11), month(12), month(13)}
    first = found[month(13), 1]
    assert (first.actual_qty, first.forecast_mean, first.forecast_naive, first.forecast_line) == (4.0, None, None, None)
    scored = {(r.model, r.steps): r for r in origins.accuracy_by_steps(rows).collect()}
    assert scored["mean", 1].n_obs == 0 and scored["mean", 1].mape is None


def test_models_cover_the_holdout_rows(spark, sf_dir):
    from veracast.plans.catalog import QUERIES

    key = ["Material_ID", "Sales_Date"]
    plain = {tuple(r) for r in QUERIES["backtest_holdout"](spark, sf_dir).select(*key).collect()}
    for name in ("ets", "arima", "stlf"):
        rows = QUERIES[f"backtest_{name}"](spark, sf_dir).collect()
        assert {(r.Material_ID, r.Sales_Date) for r in rows} == plain and len(rows) == len(plain)
        assert all(r[f"Forecast_{name.upper()}"] >= 0 for r in rows)
    products = len({p for p, _ in plain})
    forms, orders, weights = (
        QUERIES[n](spark, sf_dir).collect() for n in ("ets_fit", "arima_orders", "holt_winters_fit")
    )
    assert len(forms) == len(orders) == products
    assert {r.form for r in forms} <= {*statespace.FORMS, ""}
    assert all(r.n_train >= 24 and 0 <= r.alpha <= 1 and r.sse >= 0 for r in weights)


def test_stacked_search_finds_the_same_in_fewer_calls():
    draw = np.random.default_rng(3)
    y = np.round(draw.uniform(1, 60, (7, 30)))
    y[0], y[1] = 5.0, np.arange(30.0)  # no noise; a zero, which no multiplicative form takes
    for form in statespace.FORMS:
        names = statespace.weights_of(form)
        axes, bounds = ([held[name] for name in names] for held in (statespace.AXES, statespace.BOUNDS))
        rows = {False: [], True: []}

        def criterion(weights, stacked):
            rows[stacked].append(len(weights))
            if stacked:
                return statespace.deviance_of(y, form, 12)(weights)
            return statespace.deviance(y, form, 12, weights)

        one, many = (
            bounded_minimum(
                lambda w: criterion(w, stacked), len(y), axes, bounds, 2, 2, 5, stacked=stacked
            )
            for stacked in (False, True)
        )
        assert np.array_equal(one[0], many[0]) and np.array_equal(one[1], many[1])
        assert sum(rows[True]) == sum(rows[False]) and 2 * len(rows[True]) < len(rows[False])
