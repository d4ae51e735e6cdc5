"""Top-k inner products against all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from veracast.llm import mtree

KINDS = "vec_id long, embedding array<float>, score double, page int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, v, 0.5, 3) for i, v in rows], KINDS)


def _search(spark, rows, k=10, every=10):
    vectors = mtree.integer_vectors(_frame(spark, rows), 1024)
    found = mtree.top_inner_products(vectors, F.col("vec_id") % every == 0, k).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)


def _plain(rows, k=10, every=10):
    whole = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or x != x or abs(x) == float("inf") for x in v):
            continue
        import numpy as np

        whole.setdefault(i, []).append([int(x) for x in np.floor(np.float32(v).astype(float) * 1024)])
    out = []
    for q in whole:
        if q % every:
            continue
        for query in {tuple(x) for x in whole[q]}:
            scored = {
                (-sum(a * b for a, b in zip(query, v)), i) for i in whole if i != q for v in whole[i]
            }
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("page_rows", [4096, 20])
def test_clusters_and_copies(spark, monkeypatch, page_rows):
    monkeypatch.setattr(mtree, "PAGE_ROWS", page_rows)
    monkeypatch.setattr(mtree, "QUERY_ROWS", 4)
    monkeypatch.setattr(mtree, "LEAF_ROWS", 5)
    draw = random.Random(1)
    centres = [[draw.gauss(0, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [c + draw.gauss(0, 0.2) for c in centres[i % 6]]) for i in range(300)]
    rows += [(i, [0.25] * 8) for i in range(300, 400)]  # a third that are equal
    assert _search(spark, rows) == _plain(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, [None, 1.0]), (5, [])]
    rows += [(None, [1.0, 1.0]), (6, [-1.0]), (7, [0.5, 0.5, 9.0]), (10, [-0.0001, 0.0001])]
    rows += [(8, [3.0, 1.0]), (8, [3.0, 1.0]), (20, [1e5, -1e5]), (30, [1e9, 1e9])]
    assert _search(spark, rows) == _plain(rows)


def test_few_or_none(spark):
    assert _search(spark, []) == []
    assert _search(spark, [(0, [1.0])]) == []
    assert _search(spark, [(0, [1.0]), (3, [2.0])]) == [(0, 1, 3, 2048 * 1024)]


def test_best_first_skips_distances(spark):
    """In clusters, most vectors are ruled out without computing their score."""
    import numpy as np

    draw = np.random.default_rng(2)
    centres = draw.normal(0, 1000, (40, 16))
    x = np.floor(np.repeat(centres, 50, axis=0) + draw.normal(0, 10, (2000, 16))).astype(np.int64)
    page = mtree.Page(np.arange(2000), x, x[0])
    computed = []
    plain = page._scores
    page._scores = lambda rows, q: computed.append(len(rows)) or plain(rows, q)
    found = page.search(7, x[7], 10, float("-inf"))
    every = sorted(((int(v @ x[7]), -i) for i, v in enumerate(x) if i != 7), reverse=True)[:10]
    assert found == [(s, -i) for s, i in every]
    assert sum(computed) < 400
