"""Near-copies against brute-force Jaccard over all pairs."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veracast.llm import similar
from veracast.llm.similar import jaccard, shingle_set

from .test_line_templates import plain as plain_lines


def plain(rows):
    """The row with the smallest id of each component over pairs at 0.8 or more."""
    sets = [set(shingle_set(t, 5).tolist()) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in enumerate(sets):
        for j in range(i):
            if s == sets[j] or 5 * len(s & sets[j]) >= 4 * len(s | sets[j]) > 0:
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return [r for i, r in enumerate(rows) if root[i] == i]


def edited(draw, words, n):
    """The words with n of them replaced, far apart."""
    out = list(words)
    for k in range(n):
        out[(k + 1) * len(out) // (n + 1)] = f"new{draw.randrange(10**9)}"
    return out


def kept(spark, rows, folder=""):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, folder).collect())


@pytest.fixture(scope="module")
def near():
    """Pairs from 0.6 to 1, at ids of their own."""
    draw, rows = random.Random(4), []
    for pair in range(150):
        words = [f"w{draw.randrange(5000)}" for _ in range(200)]
        copy = edited(draw, words, pair % 10)
        rows += [(2 * pair, " ".join(words)), (2 * pair + 1, " ".join(copy))]
    return rows


def test_every_pair_from_the_threshold_on_is_found(spark, near):
    got, want = kept(spark, near), plain(near)
    low = [jaccard(shingle_set(a[1], 5), shingle_set(b[1], 5)) for a, b in zip(near[::2], near[1::2])]
    assert sum(0.8 <= s < 0.85 for s in low) >= 10
    assert not set(got) - set(want)


def test_nothing_below_the_threshold_is_dropped(spark, near):
    got, want = kept(spark, near), plain(near)
    low = [jaccard(shingle_set(a[1], 5), shingle_set(b[1], 5)) for a, b in zip(near[::2], near[1::2])]
    assert sum(0.7 <= s < 0.8 for s in low) >= 10
    assert not set(want) - set(got)


def test_chains_and_crowded_keys(spark):
    """A chain whose ends are far apart, and one of many near copies around no member."""
    draw = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(12):
        rows.append((i, " ".join(words)))
        words = edited(draw, words, 3)
    base = [f"v{i}" for i in range(200)]
    rows += [(100 + i, " ".join(edited(random.Random(i), base, 2 + i % 4))) for i in range(30)]
    assert kept(spark, rows) == plain(rows)


def test_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(plain_lines([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]))
    assert kept(spark, rows) == plain(rows)
    assert docs.where(F.col("doc_id").isNull()).count() == 0


def test_prefix_pairs_miss_none(spark):
    """Of random sets of few words, every pair from the threshold on is a candidate."""
    draw, rows = random.Random(3), []
    for i in range(120):
        words = [f"w{k}" for k in range(40 + i % 9)]
        for _ in range(draw.randrange(5)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(6)}"
        rows.append((i, " ".join(words)))
    sets = {i: set(shingle_set(t, 5).tolist()) for i, t in rows}
    texts = spark.createDataFrame(rows, "class long, text string")
    classes = spark.createDataFrame([(i, len(s), i) for i, s in sets.items()], "class long, n long, root long")
    found = {tuple(r) for r in similar._prefix_pairs(classes, texts, 5, 0.8).collect()}
    want = {(i, j) for i in sets for j in sets if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    assert want and want <= found


def test_a_template_under_the_threshold_makes_no_pairs(spark):
    """Every two of these have a similarity of 0.7 to 0.8; comparing all would take 79,800."""
    draw, base = random.Random(5), [f"t{i}" for i in range(200)]
    rows = [(i, " ".join(edited(draw, draw.sample(base, 0) + base, 5 + i % 2))) for i in range(400)]
    sets = [set(shingle_set(t, 5).tolist()) for _, t in rows]
    texts = spark.createDataFrame(rows, "class long, text string")
    classes = spark.createDataFrame([(i, len(s), i) for i, s in enumerate(sets)], "class long, n long, root long")
    assert similar._prefix_pairs(classes, texts, 5, 0.8).count() < 400
    assert kept(spark, rows) == plain(rows)


def test_close_copies_come_from_the_trie_join(spark, monkeypatch):
    classes = [(5, 10, 0b0), (7, 10, 0b11), (8, 10, 0b1111), (9, 4, 0b1), (6, 10, -1), (4, 0, 0b11111 << 40)]
    given = spark.createDataFrame(classes, "class long, n long, print long")
    # 8 is reached over 7 only; 9 is too short to be similar; -1 has all 64 bits, 4 no words.
    found = similar.print_pairs(given, 0.8).collect()
    assert sorted(tuple(r) for r in found if r.a != 4) == [(7, 5), (8, 5)]

    asked, links = [], similar._links
    monkeypatch.setattr(similar, "_links", lambda prints, budget: asked.append(budget) or links(prints, budget))
    draw = random.Random(8)
    words = [f"w{draw.randrange(5000)}" for _ in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:-1])), (3, " ".join(words[:200])), (4, ""), (5, None)]
    assert [r[0] for r in kept(spark, rows)] == [1, 3, 4]
    assert asked == [2]
