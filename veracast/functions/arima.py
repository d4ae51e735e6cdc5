"""Autoregressive moving-average models by Hannan-Rissanen regressions, for many series at once.

Differences are taken until a unit-root test (KPSS around a level, 5 %) no longer asks for one, at
most two. A long autoregression stands in for the unseen shocks; the series is then regressed on its
own lags and those shocks, for every order up to two by two, over the same rows, so that AICc compares
like with like. Orders whose roots aren't stable, or whose shocks can't be inverted, are left out.
Regressions are solved from sums of products of lags, all series of one length as one stack.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np

from veracast.functions.forecasters import train_mean

MOST_DIFFERENCES, MOST_AR, MOST_MA = 2, 2, 2
#: Fixed value: the test's 5 % critical value around a level.
KPSS_LIMIT = 0.463
#: Roots up to here count as stable.
STABLE = 0.995
LEAST_ROWS = 20


def kpss(y: np.ndarray) -> np.ndarray:
    """The statistic of each row: large where its level wanders. Constant rows have 0."""
    n = y.shape[1]
    e = y - y.mean(axis=1, keepdims=True)
    lags = int(4 * (n / 100) ** 0.25)
    variance = (e * e).mean(axis=1)
    for lag in range(1, lags + 1):
        variance += 2 * (1 - lag / (lags + 1)) * (e[:, lag:] * e[:, :-lag]).sum(axis=1) / n
    walked = (e.cumsum(axis=1) ** 2).sum(axis=1) / n**2
    flat = variance <= 1e-12 * np.maximum((y * y).mean(axis=1), 1e-300)
    return np.where(flat, 0.0, walked / np.where(flat, 1.0, variance))


def n_differences(y: np.ndarray) -> np.ndarray:
    """Differences that each row needs."""
    found = np.zeros(len(y), dtype=int)
    for d in range(MOST_DIFFERENCES):
        need = (found == d) & (kpss(np.diff(y, d)) > KPSS_LIMIT)
        found[need] = d + 1
    return found


def lagged(y: np.ndarray, lags: int, first: int) -> np.ndarray:
    """(series, rows, lags): values 1 to ``lags`` rows back, from row ``first`` on."""
    n = y.shape[1]
    if not lags:
        return np.zeros((len(y), n - first, 0))
    return np.stack([y[:, first - k : n - k] for k in range(1, lags + 1)], axis=2)


def regressed(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(coefficients, residuals) of ``y`` on a constant and ``x``; the least ones where singular."""
    full = np.concatenate([np.ones((*x.shape[:2], 1)), x], axis=2)
    gram = np.einsum("srk,srj->skj", full, full)
    right = np.einsum("srk,sr->sk", full, y)
    found = np.einsum("skj,sj->sk", np.linalg.pinv(gram, rcond=1e-11, hermitian=True), right)
    return found, y - np.einsum("srk,sk->sr", full, found)


def autoregression(y: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """(constant and p coefficients, residuals) by least squares over all rows with p before them."""
    return regressed(lagged(y, p, p), y[:, p:])


def _largest_root(coefficients: np.ndarray) -> np.ndarray:
    """Of 1 = c1/z + c2/z^2 + ...: the largest absolute z per row."""
    n, k = coefficients.shape
    if not k:
        return np.zeros(n)
    companion = np.zeros((n, k, k))
    companion[:, 0] = coefficients
    companion[:, np.arange(1, k), np.arange(k - 1)] = 1
    return np.abs(np.linalg.eigvals(companion)).max(axis=1)


def shocks(y: np.ndarray, order: int) -> np.ndarray:
    """Residuals of a long autoregression; 0 for the rows before it."""
    out = np.zeros_like(y)
    out[:, order:] = autoregression(y, order)[1]
    return out


def fit_orders(z: np.ndarray, p_most: int = MOST_AR, q_most: int = MOST_MA):
    """(p, q, coefficients) with the least AICc per row: constant, p own lags, q shocks; and shocks."""
    n = z.shape[1]
    long = max(p_most + q_most, min(int(np.ceil(10 * np.log10(n))), n // 4))
    first = min(long + q_most, n // 2)
    e, y = shocks(z, long), z[:, first:]
    best = np.full(len(z), np.inf)
    orders = np.zeros((len(z), 2), dtype=int)
    kept = np.zeros((len(z), 1 + p_most + q_most))
    rows = y.shape[1]
    for p, q in sorted(product(range(p_most + 1), range(q_most + 1)), key=sum):
        x = np.concatenate([lagged(z, p, first), lagged(e, q, first)], axis=2)
        found, residuals = regressed(x, y)
        k = p + q + 2
        if rows - k - 1 <= 0:
            continue
        floor = (1e-9 * np.maximum(np.abs(z).mean(axis=1), 1e-9)) ** 2
        criterion = rows * np.log(np.maximum((residuals**2).mean(axis=1), floor))
        criterion += 2 * k + 2 * k * (k + 1) / (rows - k - 1)
        sound = (_largest_root(found[:, 1 : 1 + p]) < STABLE) & (
            _largest_root(-found[:, 1 + p :]) < STABLE
        )
        better = sound & (criterion < best - 1e-9)
        best[better], orders[better] = criterion[better], (p, q)
        kept[better] = 0
        kept[better, : 1 + p] = found[better, : 1 + p]
        kept[better, 1 + p_most : 1 + p_most + q] = found[better, 1 + p :]
    return orders, kept, e


def _forecast(z: np.ndarray, kept: np.ndarray, orders: np.ndarray, horizon: int) -> np.ndarray:
    """Differenced values ahead, with the model's own shocks over the rows."""
    p, q = MOST_AR, MOST_MA
    ar, ma = kept[:, 1 : 1 + p], kept[:, 1 + p :]
    values, e = z.copy(), np.zeros_like(z)

    def step(t: int) -> np.ndarray:
        out = kept[:, 0].copy()
        for k in range(1, p + 1):
            out += ar[:, k - 1] * values[:, t - k]
        for k in range(1, q + 1):
            out += ma[:, k - 1] * e[:, t - k]
        return out

    start = max(p, q)
    for t in range(start, z.shape[1]):
        e[:, t] = values[:, t] - step(t)
    for _ in range(horizon):
        values = np.concatenate([values, np.zeros((len(z), 1))], axis=1)
        e = np.concatenate([e, np.zeros((len(z), 1))], axis=1)
        values[:, -1] = step(values.shape[1] - 1)
    return values[:, z.shape[1] :]


def choose_order(train: Sequence[np.ndarray], horizon: int):
    """Per series: (p, d, q) and forecasts. Series under ``LEAST_ROWS`` rows have no order and their mean."""
    out = train_mean(train, horizon)
    chosen: list[tuple[int, int, int] | None] = [None] * len(train)
    lengths = np.array([len(series) for series in train])
    for length in np.unique(lengths[lengths >= LEAST_ROWS]):
        rows = np.flatnonzero(lengths == length)
        y = np.stack([train[i] for i in rows]).astype(float)
        need = n_differences(y)
        for d in np.unique(need):
            some = need == d
            levels = [np.diff(y[some], k) for k in range(d + 1)]
            orders, kept, _ = fit_orders(levels[-1])
            ahead = _forecast(levels[-1], kept, orders, horizon)
            for level in reversed(levels[:-1]):
                ahead = level[:, -1:] + ahead.cumsum(axis=1)
            out[rows[some]] = ahead
            for i, (p, q) in zip(rows[some], orders.tolist()):
                chosen[i] = (p, int(d), q)
    return chosen, out


def arima(train: Sequence[np.ndarray], horizon: int) -> np.ndarray:
    """A forecaster for the back-test."""
    return choose_order(train, horizon)[1]
