"""Bounded minimum search for many series at once, for model fits inside Spark tasks.

A criterion takes one row of parameters per series and returns one value per series. All series of
an Arrow batch move together, so a search costs numpy calls per batch and not Python steps per
product. What is found is never worse than any point that was tried, the grid included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import product

import numpy as np

Criterion = Callable[[np.ndarray], np.ndarray]
_GOLDEN = (np.sqrt(5.0) - 1) / 2
#: Rows that a stacked criterion takes at once.
STACKED_ROWS = 4_096


def _value(criterion: Criterion, at: np.ndarray) -> np.ndarray:
    found = criterion(at)
    return np.where(np.isfinite(found), found, np.inf)


def _along(
    criterion: Criterion, at: np.ndarray, value: np.ndarray, column: int, low, high, cuts: int,
    stacked: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """The best of ``low``, ``high`` and golden section cuts of ``column`` between them."""

    def moved(x: np.ndarray) -> np.ndarray:
        point = at.copy()
        point[:, column] = x
        return point

    def tried(x: np.ndarray, found: np.ndarray | None = None) -> np.ndarray:
        nonlocal at, value
        point = moved(x)
        found = _value(criterion, point) if found is None else found
        better = found < value
        at, value = np.where(better[:, None], point, at), np.where(better, found, value)
        return found

    left, right = high - _GOLDEN * (high - low), low + _GOLDEN * (high - low)
    first = (low, high, left, right)  # no cut reaches an end
    if stacked:  # points differ in this column alone, so none depends on another's value
        known = _value(criterion, np.concatenate([moved(x) for x in first])).reshape(4, -1)
    else:
        known = [None] * 4
    *_, f_left, f_right = [tried(x, f) for x, f in zip(first, known)]
    for _ in range(cuts):
        down = f_left <= f_right
        low, high = np.where(down, low, left), np.where(down, right, high)
        x = np.where(down, high - _GOLDEN * (high - low), low + _GOLDEN * (high - low))
        found = tried(x)
        left, right = np.where(down, x, right), np.where(down, left, x)
        f_left, f_right = np.where(down, found, f_right), np.where(down, f_left, found)
    return at, value


def bounded_minimum(
    criterion: Criterion,
    n: int,
    axes: Sequence[Sequence[float]],
    bounds: Sequence[tuple[float, float]],
    starts: int = 3,
    rounds: int = 4,
    cuts: int = 7,
    every_axis: bool = False,
    stacked: bool = False,
) -> tuple[np.ndarray, np.ndarray]:
    """(parameters, criterion) of ``n`` series, each parameter within its bounds.

    The grid of all ``axes`` is tried. The best points of the ``starts`` best values on the first
    axis, which lie in different basins sooner than the best points of all do, are searched along one
    coordinate after the other by golden section, in brackets that shrink from round to round. A
    last, narrow round goes over the best of them. With ``every_axis`` the best point of each value on
    each axis gets one round, and the ``starts`` best of what they found get the others.

    A ``stacked`` criterion also takes a multiple of ``n`` rows, the series one after the other again
    and again, so that few series make large matrices too; what is found is the same.
    """
    grid = np.array(list(product(*axes)), dtype=float)
    at_once = max(1, STACKED_ROWS // n) if stacked else 1
    values = np.concatenate(
        [
            _value(criterion, np.repeat(grid[i : i + at_once], n, axis=0)).reshape(-1, n)
            for i in range(0, len(grid), at_once)
        ]
    )
    by_first = values.reshape(len(axes[0]), -1, n)
    inner = by_first.argmin(axis=1)
    best_of = np.take_along_axis(by_first, inner[:, None], 1)[:, 0]
    order = best_of.argsort(axis=0, kind="stable")
    across = np.arange(n)

    def start_at(k: int) -> tuple[np.ndarray, np.ndarray]:
        first = order[k]
        return grid[first * by_first.shape[1] + inner[first, across]], best_of[first, across]

    limits = np.array(bounds, dtype=float)
    width = np.array([max(np.diff(sorted(a)), default=hi - lo) for a, (lo, hi) in zip(axes, limits)])
    best_at, best = start_at(0)

    def descend(at: np.ndarray, value: np.ndarray, scale: float, times: int, done: int = 0):
        for turn in range(done, times):
            for column in range(grid.shape[1]):
                reach = width[column] * scale * 0.5**turn
                low = np.maximum(at[:, column] - reach, limits[column, 0])
                high = np.minimum(at[:, column] + reach, limits[column, 1])
                at, value = _along(criterion, at, value, column, low, high, cuts, stacked)
        return at, value

    def from_starts(count: int):
        if not stacked:
            yield from (descend(*start_at(k), 1.0, rounds) for k in range(count))
            return
        at, value = map(np.concatenate, zip(*map(start_at, range(count))))
        at, value = descend(at, value, 1.0, rounds)
        yield from zip(np.split(at, count), np.split(value, count))

    def from_every_axis():
        cube, first = values.reshape(*map(len, axes), n), []
        places = np.arange(len(grid)).reshape(cube.shape[:-1])
        for axis, tried in enumerate(axes):
            for i in range(len(tried)):
                place = places.take(i, axis).ravel()
                best_here = place[values[place].argmin(axis=0)]
                first.append(descend(grid[best_here], values[best_here, across], 1.0, 1))
        reached, value = np.stack([at for at, _ in first]), np.stack([v for _, v in first])
        order = value.argsort(axis=0, kind="stable")
        for k in order[:starts]:
            yield descend(reached[k, across], value[k, across], 1.0, rounds, 1)

    found = from_starts(min(starts, len(axes[0])))
    if every_axis:
        found = from_every_axis()
    for at, value in found:
        better = value < best
        best_at, best = np.where(better[:, None], at, best_at), np.where(better, value, best)
    return descend(best_at, best, 0.05, 2)
