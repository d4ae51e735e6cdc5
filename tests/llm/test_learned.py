"""Toxicity and quality: held-out accuracy, calibration, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from veracast.llm import quality, toxicity
from veracast.llm.common import bucket, labelled
from veracast.llm.queries import QUERIES

LABELS = "doc_id long, quality int, toxic int"


def _rows(n=400):
    """Texts of random words; toxic ones hold an insult, bad ones are shouted symbols."""
    draw = random.Random(7)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = [draw.choice(vocabulary) for _ in range(draw.randint(20, 60))]
        toxic, bad = i % 5 == 0, i % 7 == 0
        if toxic:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(["zounds", "zoundsing", "villain"]))
        text = " ".join(words)
        rows.append((i, " ".join(f"{w.upper()}$$$" for w in words) if bad else text))
        labels.append((i, int(not bad), int(toxic)))
    return rows, labels


def _accuracy(found, labels, column, held):
    truth = {i: (q, t)[column] for i, q, t in labels}
    rows = [r for r in found if held(r.doc_id)]
    return np.mean([(r.score >= 0.3) == truth[r.doc_id] for r in rows])


def test_toxicity_holds_out(spark, messy):
    rows, labels = _rows()
    usable = F.col("doc_id") % 4 != 2
    found = toxicity.toxicity(messy(rows), spark.createDataFrame(labels, LABELS), usable).collect()
    assert len(found) == len(rows)
    assert _accuracy(found, labels, 1, lambda i: i % 4 == 2) > 0.97


def test_weights_are_few(spark, messy):
    rows, labels = _rows()
    model = toxicity.fit(
        messy(rows), spark.createDataFrame(labels, LABELS), "toxic", F.lit(True), toxicity.Ftrl()
    )
    assert 0 < len(model["slots"]) < 300


def test_groups_are_averaged(spark, messy, monkeypatch):
    monkeypatch.setattr(toxicity, "GROUP_ROWS", 150)
    rows, labels = _rows()
    found = toxicity.toxicity(
        messy(rows), spark.createDataFrame(labels, LABELS), F.col("doc_id") % 4 != 2
    ).collect()
    assert _accuracy(found, labels, 1, lambda i: i % 4 == 2) > 0.9


def test_quality_holds_out(spark, messy):
    rows, labels = _rows()
    usable = F.col("doc_id") % 5 != 0
    found = quality.quality(messy(rows), spark.createDataFrame(labels, LABELS), usable).collect()
    assert len(found) == len(rows)
    assert _accuracy(found, labels, 0, lambda i: i % 5 == 0) > 0.97
    kept = quality.keep_good(messy(rows), spark.createDataFrame(labels, LABELS), usable, 0.3)
    assert kept.columns == messy(rows).columns
    by_score = {r.doc_id for r in found if r.score >= 0.3}
    assert {r.doc_id for r in kept.collect()} == by_score


@pytest.mark.parametrize("apply", [toxicity.toxicity, quality.quality])
def test_odd_rows(spark, messy, odd_rows, apply):
    rows, labels = _rows(120)
    labels += [(5, None, None), (None, 1, 1), (7, 9, 9), (0, 0, 0), (0, 1, 1)]
    found = apply(
        messy(rows + odd_rows), spark.createDataFrame(labels, LABELS), F.lit(True)
    ).collect()
    assert len(found) == len(rows) + len(odd_rows)
    assert all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if r.doc_id == 3}
    assert empty <= {r.score for r in found if r.doc_id == 2}


@pytest.mark.parametrize("apply, value", [(toxicity.toxicity, 0.0), (quality.quality, 1.0)])
def test_without_labels_or_rows(spark, messy, apply, value):
    none = spark.createDataFrame([], LABELS)
    found = apply(messy([(1, "a text")]), none, F.lit(True)).collect()
    assert [r.score for r in found] == [pytest.approx(value)]
    assert apply(messy([]), none, F.lit(True)).collect() == []


def test_labels_once_per_id_and_bounded(spark):
    rows = [(i % 500, 1, 0) for i in range(1000)] + [(3, 0, 1), (None, 1, 1), (4, 1, 7)]
    labels = spark.createDataFrame(rows, LABELS)
    every = {r.doc_id: r.label for r in labelled(labels, "toxic", F.lit(True), 1000).collect()}
    assert len(every) == 500 and every[3] == 1 and every[4] == 0
    assert 20 < labelled(labels, "toxic", F.lit(True), 50).count() < 90


@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=30))
@settings(max_examples=100, deadline=None)
def test_steps_rise(bins):
    total = np.array([float(a + b) for a, b in bins])
    steps = quality.rising_steps(total, np.array([float(a) for a, _ in bins]))
    assert len(steps) == len(bins) and (np.diff(steps) >= 0).all()
    assert ((0 <= steps) & (steps <= 1)).all()


def test_fourier_features_approximate_the_kernel():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(40, quality.N_STATISTICS))
    z = quality._cosines(x, np.zeros(x.shape[1]), np.ones(x.shape[1]))[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(2) / (2 * quality.WIDTH**2))
    assert np.abs(z @ z.T - exact).mean() < 0.08


@pytest.mark.parametrize(
    "name, label, remainder, n", [("op1", "toxic", 2, 4), ("op5", "quality", 0, 5)]
)
def test_queries_on_given_tables(spark, sf_dir, name, label, remainder, n):
    query = next(q for k, q in QUERIES.items() if k.startswith(name))
    found = query(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found.count() == docs.count()
    wrong = found.where(F.col("held_out") != (bucket(F.col("doc_id"), n) == remainder))
    assert wrong.count() == 0
    assert found.where("predicted <> cast(score >= 0.3 AS int)").count() == 0
