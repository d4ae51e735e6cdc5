"""Quality by ridge regression on random Fourier features of document statistics.

A text becomes a short vector of statistics (length, shares of kinds of characters, repetition).
Cosines of random projections of it approximate a Gaussian kernel. Each partition of the labelled
rows sums its part of the normal equations; the sums add up to the ridge solution. Scores of
labelled rows that took no part in the fit, counted in narrow bins, give a rising step function
(pool adjacent violators) that turns a raw score into a probability.

Texts are read once: their statistics are staged, a few numbers a row, and fit and scores work on
those. Null and empty texts have the statistics of an empty text. Without usable labels every
score is 1, so nothing is rejected. Rows that share an id are scored each by itself.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import in_arrow, labelled, map_batches, ready_workers
from veracast.sources.scratch import stage

#: Labelled rows to learn from, and tasks that sum the normal equations.
SAMPLE_ROWS, SUM_TASKS = 200_000, 8
FEATURES, WIDTH, RIDGE, SEED = 256, 3.0, 1.0, 20
#: Raw scores are counted in this many bins for the calibration.
BINS = 1024

_LOWER, _UPPER, _DIGIT, _BLANK, _LINE, _STOP, _OTHER, _WIDE, _CONTROL = range(9)


def _classes() -> np.ndarray:
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    kinds[:32] = _CONTROL
    kinds[127] = _CONTROL
    kinds[ord("a") : ord("z") + 1] = _LOWER
    kinds[ord("A") : ord("Z") + 1] = _UPPER
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    kinds[list(b" \t")] = _BLANK
    kinds[list(b"\n\r")] = _LINE
    kinds[list(b".,;:?'\"()-")] = _STOP
    kinds[128:] = _WIDE
    return kinds


_CLASS = _classes()
N_STATISTICS = 16


def statistics(text: str) -> list[float]:
    """``N_STATISTICS`` numbers that say how a text looks, all 0 for an empty one."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if not len(raw):
        return [0.0] * N_STATISTICS
    kinds = np.bincount(_CLASS[raw], minlength=9) / len(raw)
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    distinct = len(set(words))
    inner = sum(not w[-1].isalnum() for w in words) / n
    return [
        math.log1p(len(raw)),
        kinds[_UPPER],
        kinds[_DIGIT],
        kinds[_BLANK],
        math.log1p(100 * kinds[_LINE]),
        kinds[_STOP],
        kinds[_OTHER],
        math.sqrt(kinds[_OTHER]),
        kinds[_WIDE],
        kinds[_CONTROL],
        math.log(max(1, len(text)) / n),
        distinct / n,
        math.log(n / max(1, distinct)),
        len(set(lines)) / max(1, len(lines)),
        inner,
        math.sqrt(kinds[_UPPER]),
    ]


def document_statistics(docs: DataFrame, carried: list[str]) -> DataFrame:
    """``carried`` columns and the statistics of every row."""
    kinds = dict(docs.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carried) + ", statistics array<float>"

    def build():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(len(carried)).to_pylist()
            made = pa.array([statistics(t) for t in texts], pa.list_(pa.float32()))
            columns = [*batch.columns[: len(carried)], made]
            return pa.RecordBatch.from_arrays(columns, [*carried, "statistics"])

        return work

    rows = docs.select(*carried, F.coalesce("text", F.lit("")).alias("text"))
    return map_batches(rows, build, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, N_STATISTICS).astype(float)


def _cosines(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant; the same draw wherever it is made."""
    draw = np.random.default_rng(SEED)
    w = draw.normal(0, 1 / WIDTH, (N_STATISTICS, FEATURES))
    b = draw.uniform(0, 2 * math.pi, FEATURES)
    made = math.sqrt(2 / FEATURES) * np.cos(np.clip((x - mean) / scale, -8, 8) @ w + b)
    return np.hstack([made, np.ones((len(x), 1))])


def _summed(df: DataFrame, n: int, part) -> np.ndarray:
    """The sum of ``part(statistics, label)`` (``n`` numbers) over the partitions of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n)
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                rows = batch.slice(first, 2048)
                total += part(_matrix(rows.column(0)), rows.column(1).to_numpy().astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    few = df.select("statistics", "label").coalesce(SUM_TASKS)
    rows = in_arrow(few, run, "sums binary").collect()
    return sum((np.frombuffer(r["sums"]) for r in rows), np.zeros(n))


def rising_steps(total: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Least-squares rising probabilities of the bins; empty bins take those around them."""
    blocks: list[list[float]] = []  # rows, positives, first bin, last bin
    for i in np.flatnonzero(total).tolist():
        blocks.append([total[i], positive[i], i, i])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    if not blocks:
        return np.ones(len(total))
    at = [x for b in blocks for x in (b[2], b[3])]
    # One row of each kind on top keeps a small block off certainty.
    level = [(b[1] + 0.5) / (b[0] + 1) for b in blocks for _ in range(2)]
    return np.interp(np.arange(len(total)), at, np.maximum.accumulate(level))


def fit(statistics_of: DataFrame, labels: DataFrame, label: str, usable: Column) -> dict:
    """From staged (doc_id, statistics) and labels: what ``raw_scores`` and ``steps`` need."""
    sample = labelled(labels, label, usable, SAMPLE_ROWS)
    known = stage(
        statistics_of.join(sample, "doc_id").select(
            "statistics", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("spare")
        ),
        "quality-known",
    )
    n = N_STATISTICS
    moments = _summed(
        known, 2 * n + 1, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])
    )
    if not moments[0]:
        return {}
    mean = moments[1 : n + 1] / moments[0]
    spread = np.sqrt(np.maximum(moments[n + 1 :] / moments[0] - mean * mean, 0))
    scale = np.where(spread > 1e-9, spread, 1.0)
    d = FEATURES + 1

    def equations(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        made = _cosines(x, mean, scale)
        return np.concatenate([(made.T @ made).ravel(), made.T @ y])

    sums = _summed(known.where("not spare"), d * d + d, equations)
    penalty = np.full(d, RIDGE * 0.01)
    penalty[-1] = 1e-6
    weights = np.linalg.solve(sums[: d * d].reshape(d, d) + np.diag(penalty), sums[d * d :])

    def counts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        bins = raw_bins(_cosines(x, mean, scale) @ weights)
        return np.concatenate([np.bincount(bins, minlength=BINS), np.bincount(bins, y, BINS)])

    spare = _summed(known.where("spare"), 2 * BINS, counts)
    if spare[:BINS].sum() < 50:  # too few apart: the fitted rows calibrate as well
        spare = _summed(known, 2 * BINS, counts)
    steps = rising_steps(spare[:BINS], spare[BINS:])
    return {"mean": mean, "scale": scale, "weights": weights, "steps": steps}


def raw_bins(raw: np.ndarray) -> np.ndarray:
    """Bins of raw scores; a fit of 0 and 1 stays mostly between -0.5 and 1.5."""
    return np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int64)


def _scores(x: np.ndarray, model: dict) -> np.ndarray:
    """Calibrated scores of rows of statistics."""
    places = np.arange(BINS) / BINS * 2 - 0.5 + 1 / BINS
    raw = _cosines(x, model["mean"], model["scale"]) @ model["weights"]
    return np.interp(raw, places, model["steps"])


def score(statistics_of: DataFrame, model: dict) -> DataFrame:
    """The columns of ``statistics_of``, with score in place of the statistics."""
    kept = [c for c in statistics_of.columns if c != "statistics"]
    if not model:
        return statistics_of.select(*kept, F.lit(1.0).alias("score"))
    kinds = dict(statistics_of.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept) + ", score double"
    sent = statistics_of.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2048):
                rows = batch.slice(first, 2048)
                scores = _scores(_matrix(rows.column(len(kept))), sent.value)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[: len(kept)], pa.array(scores)], [*kept, "score"]
                )

    return in_arrow(statistics_of.select(*kept, "statistics"), run, schema)


def quality(docs: DataFrame, labels: DataFrame, usable: Column) -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = stage(document_statistics(rows, ["doc_id"]), "quality-statistics")
    return score(known, fit(known, labels, "quality", usable))


def keep_good(docs: DataFrame, labels: DataFrame, usable: Column, least: float) -> DataFrame:
    """The rows of ``docs``, whole, with a score of ``least`` or more.

    Learns from the texts of the sample alone and scores in the pass that filters, so texts are
    neither shuffled nor staged.
    """
    sample = labelled(labels, "quality", usable, SAMPLE_ROWS)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # About SAMPLE_ROWS ids.
    rows = rows.join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    known = stage(document_statistics(rows, ["doc_id"]), "quality-statistics")
    model = fit(known, labels, "quality", usable)
    if not model:
        return docs
    ready_workers(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts.fillna("")]).reshape(-1, N_STATISTICS)
        return pd.Series(_scores(x.astype(np.float32).astype(float), sent.value))

    return docs.where(scored(docs["text"]) >= least)
