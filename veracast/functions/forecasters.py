"""Forecasters for the back-test: small numpy helpers that run inside Spark tasks.

A forecaster takes the train series of one Arrow batch (a list of 1-d arrays) and a horizon,
and returns an array of shape (series, horizon). Spark owns grouping, shuffling and batching.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

import numpy as np

from veracast.functions.search import bounded_minimum

Forecaster = Callable[[Sequence[np.ndarray], int], np.ndarray]

# Smoothing weights tried for level, trend and season; the best fit on the train rows wins.
WEIGHTS = (0.05, 0.2, 0.4, 0.7)
TREND_WEIGHTS = (0.0, 0.05, 0.2)
SEASON_WEIGHTS = (0.05, 0.2, 0.4)
# Steps from the best point of the grid, along each weight in turn.
STEPS = (0.1, 0.05, 0.02, 0.01)


def train_mean(train: Sequence[np.ndarray], horizon: int) -> np.ndarray:
    return np.repeat([[series.mean()] for series in train], horizon, axis=1)


def last_value(train: Sequence[np.ndarray], horizon: int) -> np.ndarray:
    return np.repeat([[series[-1]] for series in train], horizon, axis=1)


def per_series(fit: Callable[[np.ndarray, int], np.ndarray]) -> Forecaster:
    """Lift a one-series model to a batch; a series it fails on gets its train mean."""

    def run(train: Sequence[np.ndarray], horizon: int) -> np.ndarray:
        out = train_mean(train, horizon)
        for i, series in enumerate(train):
            try:
                out[i] = fit(series, horizon)
            except Exception:  # noqa: BLE001 - any model failure means "use the mean"
                continue
        return out

    return run


def _additive(y: np.ndarray, season: int, horizon: int, weights: tuple) -> tuple:
    """Many equally long series: (squared error, forecasts). A weight may differ by series."""
    alpha, beta, gamma = weights
    first, second = y[:, :season].mean(axis=1), y[:, season : 2 * season].mean(axis=1)
    slope = (second - first) / season
    # The first season's mean sits at its middle; start the level one step before the data.
    level = first - slope * (season + 1) / 2
    steps = np.arange(1, season + 1)
    cycle = y[:, :season] - (level[:, None] + slope[:, None] * steps)
    error = np.zeros(len(y))
    for t in range(y.shape[1]):
        slot = t % season
        base = level + slope
        residual = y[:, t] - base - cycle[:, slot]
        error += residual**2
        new_level = base + alpha * residual
        slope = slope + beta * (new_level - level - slope)
        cycle[:, slot] += gamma * (1 - alpha) * residual
        level = new_level
    ahead = np.arange(1, horizon + 1)
    slots = (y.shape[1] + ahead - 1) % season
    return error, level[:, None] + slope[:, None] * ahead + cycle[:, slots]


def _nudged(weights: np.ndarray, step: float) -> list[np.ndarray]:
    """Each weight of each series a step up and a step down, within 0 and 1."""
    moved = []
    for column in range(weights.shape[1]):
        for sign in (1, -1):
            other = weights.copy()
            other[:, column] = np.clip(other[:, column] + sign * step, 0.0, 1.0)
            moved.append(other)
    return moved


def holt_winters(
    season: int = 12, weights: tuple[float, float, float] | None = None
) -> Forecaster:
    """Additive level, trend and season; a series shorter than two seasons gets its mean.

    Without given ``weights`` each series takes the best of a grid on its train rows, then moves
    it in ever smaller steps along one weight at a time. Series of equal length are smoothed
    together as one matrix, so the search costs numpy calls per batch and not Python steps per
    product.
    """
    grid = [weights] if weights else list(product(WEIGHTS, TREND_WEIGHTS, SEASON_WEIGHTS))
    steps = () if weights else STEPS

    def run(train: Sequence[np.ndarray], horizon: int) -> np.ndarray:
        out = train_mean(train, horizon)
        lengths = np.array([len(series) for series in train])
        for length in np.unique(lengths[lengths >= 2 * season]):
            rows = np.flatnonzero(lengths == length)
            y = np.stack([train[i] for i in rows]).astype(float)
            best = np.full(len(rows), np.inf)
            chosen = np.zeros((len(rows), 3))

            def attempt(tried: np.ndarray) -> None:
                error, forecast = _additive(y, season, horizon, tried.T)
                better = error < best
                best[better], chosen[better] = error[better], tried[better]
                out[rows[better]] = forecast[better]

            for point in grid:
                attempt(np.tile(point, (len(rows), 1)))
            for step in steps:
                for tried in _nudged(chosen, step):
                    attempt(tried)
        return out

    return run


#: Where the fit of weights starts from, and decimals of what it reports.
FIT_AXES = (
    (0.0, 0.05, 0.2, 0.4, 0.65, 0.9),
    (0.0, 0.05, 0.2, 0.5, 0.9),
    (0.0, 0.05, 0.3, 0.6, 0.95),
)
FIT_DIGITS = 6


def _same_lengths(train: Sequence[np.ndarray]):
    """(places, matrix) of the series of each length."""
    lengths = np.array([len(series) for series in train])
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        yield rows, np.stack([train[i] for i in rows]).astype(float)


def additive_errors(
    train: Sequence[np.ndarray], season: int, weights: Sequence[float]
) -> np.ndarray:
    """Squared one-step error of each series with the same weights."""
    out = np.full(len(train), np.nan)
    for rows, y in _same_lengths(train):
        tried = np.tile(np.array(weights, dtype=float), (len(y), 1))
        out[rows] = _additive(y, season, 1, tried.T)[0]
    return out


def fitted_additive(train: Sequence[np.ndarray], season: int) -> tuple[np.ndarray, np.ndarray]:
    """(weights, squared error) of additive Holt-Winters for series of two seasons or more.

    Weights are searched between 0 and 1 and rounded; the error is that of the rounded ones.
    """
    weights, errors = np.zeros((len(train), 3)), np.full(len(train), np.nan)
    for rows, y in _same_lengths(train):
        found, _ = bounded_minimum(
            lambda w: _additive(y, season, 1, w.T)[0],
            len(y),
            FIT_AXES,
            [(0.0, 1.0)] * 3,
            starts=len(FIT_AXES[0]),
            every_axis=True,
        )
        weights[rows] = found.round(FIT_DIGITS)
        errors[rows] = _additive(y, season, 1, weights[rows].T)[0]
    return weights, errors
