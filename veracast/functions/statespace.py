"""Exponential smoothing as innovation state-space forms, for many series of one length at once.

A form is three letters: error A(dditive) or M(ultiplicative), trend N(one), A(dditive) or
D(amped), season N(one), A(dditive) or M(ultiplicative). The states move alike for both errors, since
a multiplicative error is the additive one in units of the forecast; what differs is the likelihood
that weights are fitted by and forms are chosen by (AICc).

States start from two seasons: the line through their means, and each season's mean distance from
it. Shorter series start on the line through the means of their halves, and have only forms without
season.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from veracast.functions.forecasters import train_mean
from veracast.functions.search import bounded_minimum

#: An additive error with a multiplicative season is left out: its variance isn't bounded.
FORMS = tuple(
    error + trend + season
    for error in "AM"
    for trend in "NAD"
    for season in "NAM"
    if (error, season) != ("A", "M")
)
#: Weights: level; trend as a share of level; season as a share of 1 - level; damping.
AXES = {
    "alpha": (0.02, 0.1, 0.3, 0.6, 0.9),
    "beta": (0.01, 0.1, 0.4),
    "gamma": (0.01, 0.2, 0.6),
    "phi": (0.8, 0.9, 0.97),
}
BOUNDS = {"alpha": (1e-4, 0.9999), "beta": (1e-4, 0.9999), "gamma": (1e-4, 0.9999), "phi": (0.8, 0.98)}


def weights_of(form: str) -> list[str]:
    """Names of a form's weights."""
    names = ["alpha"]
    if form[1] != "N":
        names.append("beta")
    if form[2] != "N":
        names.append("gamma")
    if form[1] == "D":
        names.append("phi")
    return names


def n_parameters(form: str, season: int) -> int:
    """Weights, initial states and the variance."""
    seasons = season - 1 if form[2] != "N" else 0
    return len(weights_of(form)) + 1 + (form[1] != "N") + seasons + 1


def first_states(y: np.ndarray, form: str, season: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Level and slope before the first row, and the seasons from the first row on."""
    n, length = y.shape
    slope, cycle = np.zeros(n), np.zeros((n, season)) + (form[2] == "M")
    if length < 2 * season:
        half = max(1, length // 2)
        level = y[:, :half].mean(axis=1)
        if form[1] != "N" and length > 1:
            slope = (y[:, half : 2 * half].mean(axis=1) - level) / half
        return level - slope * (half + 1) / 2, slope, cycle
    first, second = y[:, :season], y[:, season : 2 * season]
    if form[1] != "N":
        slope = (second.mean(axis=1) - first.mean(axis=1)) / season
    middle = (first.mean(axis=1) + second.mean(axis=1)) / 2 if form[1] == "N" else first.mean(axis=1)
    level = middle - slope * (season + 1) / 2
    if form[2] != "N":
        line = level[:, None] + slope[:, None] * np.arange(1, 2 * season + 1)
        both = y[:, : 2 * season]
        with np.errstate(divide="ignore", invalid="ignore"):
            apart = both - line if form[2] == "A" else both / line
        cycle = (apart[:, :season] + apart[:, season:]) / 2
    return level, slope, cycle


def _prepared(y: np.ndarray, form: str, season: int) -> tuple[np.ndarray, ...]:
    """A row per month of quantities, and the first states; what no weights change."""
    level, slope, cycle = first_states(y, form, season)
    return np.ascontiguousarray(y.T), level, slope, np.ascontiguousarray(cycle.T)


def _run(
    prepared: tuple[np.ndarray, ...], form: str, season: int, weights: np.ndarray, horizon: int,
    squared: bool = True, relatively: bool = True,
):
    """``smoothed`` of prepared series; sums that aren't wanted stay zero.

    With a multiple of the series as weights, they go through one after the other in one matrix.
    """
    times = len(weights) // len(prepared[1])
    if times > 1:
        prepared = tuple(np.tile(x, times) for x in prepared)
    months, level, slope, cycle = prepared
    named = dict(zip(weights_of(form), np.ascontiguousarray(weights.T)))
    alpha = named["alpha"]
    beta = alpha * named["beta"] if "beta" in named else 0.0
    gamma = (1 - alpha) * named["gamma"] if "gamma" in named else 0.0
    phi = named.get("phi", 1.0)
    damped = "phi" in named
    trend, kind = form[1] != "N", form[2]
    relatively = relatively and form[0] == "M"
    cycle = cycle.copy()
    squares, relative, logs = np.zeros(len(level)), np.zeros(len(level)), np.zeros(len(level))
    with np.errstate(all="ignore"):
        for t in range(len(months)):
            slot = t % season
            along = phi * slope if damped else slope
            base = level + along if trend else level
            s = cycle[slot]
            mu = base if kind == "N" else base + s if kind == "A" else base * s
            e = months[t] - mu
            if squared:
                squares += e * e
            if relatively:
                share = (e / mu) ** 2
                unfit = ~(mu > 0)
                if unfit.any():
                    share[unfit] = np.inf
                relative += share
                logs += np.log(np.abs(mu))
            per_level = e / s if kind == "M" else e
            if kind != "N":
                cycle[slot] = s + gamma * (e / base if kind == "M" else e)
            level = base + alpha * per_level
            if trend:
                slope = along + beta * per_level
        ahead, out, damp, total = phi, [], phi, 0.0
        for h in range(horizon):
            total, damp = total + damp, damp * ahead
            base = level + (total if trend else 0.0) * slope
            s = cycle[(len(months) + h) % season]
            out.append(base if kind == "N" else base + s if kind == "A" else base * s)
    forecasts = np.stack(out, axis=1) if out else np.zeros((len(level), 0))
    return squares, relative, logs, forecasts


def smoothed(y: np.ndarray, form: str, season: int, weights: np.ndarray, horizon: int = 0):
    """(squared error, sum of squared relative errors, sum of log forecasts, forecasts) per series."""
    return _run(_prepared(y, form, season), form, season, weights, horizon)


def deviance(y: np.ndarray, form: str, season: int, weights: np.ndarray) -> np.ndarray:
    """-2 log likelihood up to a constant; infinite where a form doesn't suit a series."""
    return deviance_of(y, form, season)(weights)


def deviance_of(y: np.ndarray, form: str, season: int):
    """``deviance`` as a function of weights: a row per series, or several times that."""
    prepared, n = _prepared(y, form, season), y.shape[1]
    size = np.maximum(np.abs(y).mean(axis=1), 1e-9)
    # A perfect fit has no likelihood; this bound lets forms of fewer parameters win then.
    floor = n * (1e-9 * size) ** 2
    additive, usable = form[0] == "A", (y > 0).all(axis=1)

    def found(weights: np.ndarray) -> np.ndarray:
        squares, relative, logs, _ = _run(prepared, form, season, weights, 0, additive, not additive)
        times = len(weights) // len(y)
        with np.errstate(all="ignore"):
            if additive:
                return n * np.log(np.maximum(squares, np.tile(floor, times)))
            least = np.tile(floor / size**2, times)
            value = n * np.log(np.maximum(relative, least)) + 2 * logs
        return np.where(np.tile(usable, times), value, np.inf)

    return found


def fit_form(y: np.ndarray, form: str, season: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, AICc) of one form for each series."""
    names = weights_of(form)
    weights, found = bounded_minimum(
        deviance_of(y, form, season),
        len(y),
        [AXES[name] for name in names],
        [BOUNDS[name] for name in names],
        starts=2,
        rounds=2,
        cuts=5,
        stacked=True,
    )
    k, n = n_parameters(form, season), y.shape[1]
    if n - k - 1 <= 0:
        return weights, np.full(len(y), np.inf)
    return weights, found + 2 * k + 2 * k * (k + 1) / (n - k - 1)


def choose_form(
    train: Sequence[np.ndarray], season: int, horizon: int, forms: Sequence[str] = FORMS
) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Per series: form, AICc, squared error and forecasts; the least AICc wins, ties by ``forms``.

    Series of equal length go through every form together. Multiplicative forms need positive
    quantities, seasonal ones two seasons. A series that no form suits has an empty form and its
    mean as forecasts.
    """
    chosen = [""] * len(train)
    criterion, squares = np.full(len(train), np.inf), np.full(len(train), np.nan)
    out = train_mean(train, horizon)
    lengths = np.array([len(series) for series in train])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        y = np.stack([train[i] for i in rows]).astype(float)
        for form in forms:
            if form[2] != "N" and length < 2 * season + 1:
                continue
            usable = (y > 0).all(axis=1) if "M" in form else np.ones(len(y), bool)
            if not usable.any():
                continue
            places, some = rows[usable], y[usable]
            weights, found = fit_form(some, form, season)
            error, *_, forecasts = smoothed(some, form, season, weights, horizon)
            better = (found < criterion[places]) & np.isfinite(forecasts).all(axis=1)
            won = places[better]
            criterion[won], squares[won], out[won] = found[better], error[better], forecasts[better]
            for i in won:
                chosen[i] = form
    return chosen, criterion, squares, out


def ets(season: int = 12, forms: Sequence[str] = FORMS):
    """A forecaster for the back-test: each series by its own best form."""

    def run(train: Sequence[np.ndarray], horizon: int) -> np.ndarray:
        return choose_form(train, season, horizon, forms)[-1]

    return run


def fixed_form(form: str, weights: Sequence[float], season: int = 12):
    """A forecaster with one form and given weights; series under two seasons get their mean."""

    def run(train: Sequence[np.ndarray], horizon: int) -> np.ndarray:
        out = train_mean(train, horizon)
        for i, series in enumerate(train):
            if len(series) >= 2 * season:
                y = np.asarray(series, dtype=float)[None]
                out[i] = smoothed(y, form, season, np.array([weights], dtype=float), horizon)[-1][0]
        return out

    return run
