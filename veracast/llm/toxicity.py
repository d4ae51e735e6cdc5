"""Toxicity by logistic regression over hashed word n-grams, trained with FTRL-proximal.

Features say that a text holds a word, the stem of a word (its first letters), two words in a
row, or two words around a third; each is hashed to one of ``SLOTS`` places and counts once.
FTRL-proximal gives each place its own learning rate, and its L1 term leaves most weights at
exactly zero, so the model is a short list of (place, weight) that is sent to every task.

Training reads a bounded sample of labelled rows, in groups of at most about ``GROUP_ROWS``. Each
group is learned by itself and the weights are averaged by the groups' sizes. Scoring goes over
whole texts without a shuffle.

Null and empty texts have no features and get the score of the bias. Without usable labels every
score is 0. Rows that share an id are scanned each by itself; labels are taken once per id.
"""

from __future__ import annotations

import math
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import labelled, map_batches
from veracast.shipping import ship

#: Places that features are hashed to; a power of two. Bounds the model.
SLOT_BITS = 20
#: Labelled rows to learn from, and rows that one task learns from.
SAMPLE_ROWS, GROUP_ROWS = 40_000, 5_000
STEM = 4
_WORD = re.compile(r"[^\W\d_]+")


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate learning rate alpha / (beta + root of squared gradients), L1 and L2."""

    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 6.0
    l2: float = 1.0
    epochs: int = 2


class Features:
    """Places of a text's features; hashes of words are kept between texts."""

    def __init__(self, limit: int = 300_000):
        self.known: dict[str, tuple[int, int]] = {}
        self.limit = limit

    def _hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.limit:
            known.clear()
        for word in set(words).difference(known):
            known[word] = zlib.crc32(word.encode()), zlib.crc32(word[:STEM].encode(), 1)
        return np.array([known[w] for w in words], dtype=np.uint64).reshape(-1, 2)

    def __call__(self, text: str) -> np.ndarray:
        """With repeats, in no order."""
        words = _WORD.findall(text.lower())
        if not words:
            return np.zeros(0, dtype=np.int64)
        both = self._hashes(words)
        word, mixed = both[:, 0], both[:, 0] * np.uint64(0x9E3779B97F4A7C15)
        keys = [
            word,
            both[:, 1] + np.uint64(1 << 33),
            mixed[:-1] ^ word[1:],
            mixed[:-2] ^ (word[2:] + np.uint64(1 << 34)),
        ]
        spread = np.concatenate(keys) * np.uint64(0xD6E8FEB86659FD93)
        return (spread >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def train_ftrl(
    rows: list[tuple[np.ndarray, int]], rule: Ftrl
) -> tuple[dict[int, float], float]:
    """Weights other than zero, and the bias; ``rows`` have distinct places and a label."""
    z, n = np.zeros(1 << SLOT_BITS), np.zeros(1 << SLOT_BITS)
    bias = bias_n = 0.0
    for _ in range(rule.epochs):
        for places, label in rows:
            zs, ns = z[places], n[places]
            roots = np.sqrt(ns)
            shrunk = np.sign(zs) * np.maximum(np.abs(zs) - rule.l1, 0)
            w = -shrunk / ((rule.beta + roots) / rule.alpha + rule.l2)
            g = 1 / (1 + math.exp(-max(-30.0, min(30.0, bias + w.sum())))) - label
            n[places] = ns + g * g
            z[places] = zs + g - (np.sqrt(ns + g * g) - roots) / rule.alpha * w
            bias_n += g * g
            bias -= rule.alpha * g / (rule.beta + math.sqrt(bias_n))
    at = np.flatnonzero(np.abs(z) > rule.l1)
    shrunk = np.sign(z[at]) * (np.abs(z[at]) - rule.l1)
    w = -shrunk / ((rule.beta + np.sqrt(n[at])) / rule.alpha + rule.l2)
    return dict(zip(at.tolist(), w.tolist())), bias


def fit(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rule: Ftrl) -> dict:
    """Places and weights learned from a bounded sample of ``labels`` rows that are ``usable``."""
    sample = labelled(labels, label, usable, SAMPLE_ROWS)
    groups = max(1, -(-sample.count() // GROUP_ROWS))
    ship(docs.sparkSession)
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(sample), "doc_id")  # about SAMPLE_ROWS pairs of numbers
        .select(
            "label",
            F.coalesce("text", F.lit("")).alias("text"),
            F.xxhash64("doc_id", "text").alias("place"),
        )
        .withColumn("part", F.pmod("place", F.lit(groups)))
    )

    def learn(group: pa.Table) -> pa.Table:
        features = Features()
        group = group.sort_by("place")
        seen = [
            (np.unique(features(text.as_py())), int(label.as_py()))
            for text, label in zip(group.column("text"), group.column("label"))
        ]
        weights, bias = train_ftrl(seen, rule)
        size = len(seen)
        return pa.table(
            {
                "slot": pa.array([-1, *weights], pa.int32()),
                "weight": pa.array([bias * size, *(w * size for w in weights.values())]),
                "size": pa.array([size] + [0] * len(weights), pa.int64()),
            }
        )

    learned = rows.groupBy("part").applyInArrow(learn, "slot int, weight double, size long")
    totals = learned.groupBy("slot").agg(F.sum("weight").alias("w"), F.sum("size").alias("size"))
    found = {r["slot"]: (r["w"], r["size"]) for r in totals.collect()}  # SLOTS rows at most
    if not found:
        return {"slots": [], "weights": [], "bias": -math.inf}
    bias, size = found.pop(-1)
    kept = {s: w / size for s, (w, _) in sorted(found.items())}
    return {"slots": list(kept), "weights": list(kept.values()), "bias": bias / size}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def build():
        known, features = sent.value, Features()
        weights = np.zeros(1 << SLOT_BITS, dtype=np.float64)
        weights[np.array(known["slots"], dtype=np.int64)] = known["weights"]
        used = weights != 0

        def one(text: str) -> float:
            places = features(text)
            margin = known["bias"] + weights[np.unique(places[used[places]])].sum()
            return 1 / (1 + math.exp(-max(-700.0, min(700.0, margin))))

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            scores = [one(t) for t in batch.column(1).to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return map_batches(rows, build, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, usable: Column, rule: Ftrl = Ftrl()) -> DataFrame:
    return score(docs, fit(docs, labels, "toxic", usable, rule))
