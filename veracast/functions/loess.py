"""Seasonal-trend decomposition by loess, with robustness weights, for many series at once.

A local line at a place is a ratio of weighted sums of the quantities around it. Distance weights
depend on the places alone, so the sums of a whole batch are products of its matrix with fixed ones.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np

from veracast.functions.forecasters import train_mean
from veracast.functions.statespace import choose_form

#: Spans in rows, inner and outer passes; robust forecasts need no more.
SEASON_SPAN, INNER, OUTER = 13, 2, 4
#: What the seasonally adjusted part is forecast by.
ADJUSTED_FORMS = ("ANN", "AAN", "ADN")


@functools.lru_cache(maxsize=512)
def _kernel(n: int, span: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tricube weights (rows, places) of places ``first`` to ``last``, times distance and its square."""
    x = np.arange(n, dtype=float)[:, None]
    apart = x - np.arange(first, last + 1, dtype=float)[None]
    away = np.abs(apart)
    reach = np.sort(away, axis=0)[min(span, n) - 1]
    if span > n:  # as far as the span would go
        reach = reach * span / n
    share = np.minimum(away / np.maximum(reach * 1.000001, 1e-9), 1.0)
    weights = (1 - share**3) ** 3
    return weights, weights * apart, weights * apart * apart


def loess(y: np.ndarray, span: int, robust: np.ndarray | None = None, first: int = 0, last: int | None = None):
    """Local lines through the ``span`` nearest rows, at places ``first`` to ``last`` of each series.

    ``robust`` weighs rows. Where the weights leave one place, or none, the line is their mean or 0.
    """
    n = y.shape[1]
    plain, by_x, by_xx = _kernel(n, span, first, n - 1 if last is None else last)
    r = np.ones_like(y) if robust is None else robust
    s0, s1, s2 = r @ plain, r @ by_x, r @ by_xx
    t0, t1 = (r * y) @ plain, (r * y) @ by_x
    spread = s0 * s2 - s1 * s1
    line = spread > 1e-9 * np.maximum(s0 * s2, 1e-300)
    fitted = (s2 * t0 - s1 * t1) / np.where(line, spread, 1.0)
    return np.where(line, fitted, t0 / np.where(s0 > 0, s0, 1.0))


def _moving(y: np.ndarray, width: int) -> np.ndarray:
    sums = np.concatenate([np.zeros((len(y), 1)), y.cumsum(axis=1)], axis=1)
    return (sums[:, width:] - sums[:, :-width]) / width


def _odd(x: float) -> int:
    n = int(np.ceil(x))
    return n + 1 - n % 2


def decomposed(y: np.ndarray, season: int, robust: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(trend, season) of series of one length, two seasons or more."""
    n = y.shape[1]
    trend_span = _odd(1.5 * season / (1 - 1.5 / SEASON_SPAN))
    trend, seasonal, weights = np.zeros_like(y), np.zeros_like(y), np.ones_like(y)
    for outer in range(OUTER + 1 if robust else 1):
        for _ in range(INNER):
            off = y - trend
            # Each calendar month's rows by themselves, a season further at both ends.
            cycle = np.zeros((len(y), n + 2 * season))
            for slot in range(season):
                own = off[:, slot::season]
                wide = loess(own, SEASON_SPAN, weights[:, slot::season], -1, own.shape[1])
                cycle[:, slot::season][:, : wide.shape[1]] = wide
            low = _moving(_moving(_moving(cycle, season), season), 3)
            seasonal = cycle[:, season : season + n] - loess(low, _odd(season))
            trend = loess(y - seasonal, trend_span, weights)
        if outer == OUTER or not robust:
            break
        rest = np.abs(y - trend - seasonal)
        limit = 6 * np.median(rest, axis=1, keepdims=True)
        sure = limit > 1e-9 * np.maximum(np.abs(y).max(axis=1, keepdims=True), 1e-300)
        share = np.where(sure, rest / np.where(sure, limit, 1.0), 0.0)
        weights = (1 - np.minimum(share, 1.0) ** 2) ** 2
    return trend, seasonal


def stlf(season: int = 12, robust: bool = True):
    """A forecaster for the back-test: the adjusted part smoothed, the last year's season repeated.

    Series under two seasons and a row get their mean.
    """

    def run(train: Sequence[np.ndarray], horizon: int) -> np.ndarray:
        out = train_mean(train, horizon)
        lengths = np.array([len(series) for series in train])
        for length in np.unique(lengths[lengths > 2 * season]):
            rows = np.flatnonzero(lengths == length)
            y = np.stack([train[i] for i in rows]).astype(float)
            _, seasonal = decomposed(y, season, robust)
            ahead = choose_form(list(y - seasonal), season, horizon, ADJUSTED_FORMS)[-1]
            again = length - season + np.arange(horizon) % season
            out[rows] = ahead + seasonal[:, again]
        return out

    return run
