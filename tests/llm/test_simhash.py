"""Fingerprints, the trie self-join and components against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from veracast.llm import simhash


def plain_fingerprint(text, shingle):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, budget):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= budget:
                root[find(i)] = find(j)
    least = {}
    for i, doc_id in enumerate(ids):
        known = [x for x in (least.get(find(i)), doc_id) if x is not None]
        least[find(i)] = min(known, default=None)
    return [least[find(i)] for i in range(len(ids))]


def _found(df):
    return sorted(
        ((r.doc_id, r.prints[0] & (1 << 64) - 1, r.component_id) for r in df.collect()), key=str
    )


def test_odd_rows(messy, odd_rows):
    found = _found(simhash.near_duplicates(messy(odd_rows), ["doc_id"], 3, 2))
    prints = [plain_fingerprint(t, 3) for _, t in odd_rows]
    names = plain_components([i for i, _ in odd_rows], prints, 2)
    assert found == sorted(zip([i for i, _ in odd_rows], prints, names), key=str)


def test_nothing(messy):
    assert simhash.near_duplicates(messy([]), ["doc_id"], 3, 2).collect() == []


@pytest.mark.parametrize("node_rows", [100_000, 3])
@pytest.mark.parametrize("budget", [0, 2, 5])
def test_links_of_clusters(spark, monkeypatch, node_rows, budget):
    """Chains, clusters with equal blocks, and far prints; with and without splitting nodes."""
    monkeypatch.setattr(simhash, "NODE_ROWS", node_rows)
    draw = random.Random(budget)
    prints = {draw.getrandbits(64) for _ in range(100)} | {0, (1 << 64) - 1}
    for start in list(prints)[:12]:
        value = start
        for _ in range(12):  # walks of one or two bits
            value ^= 1 << draw.randrange(64)
            if draw.random() < 0.5:
                value ^= 1 << draw.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    rows = [(0, p - (1 << 64) if p >> 63 else p) for p in prints]
    table = spark.createDataFrame(rows, "table int, print long")
    edges = simhash.stage(simhash._links(table, budget), "edges")
    for r in edges.collect():
        assert r.a != r.b
    roots = {r.node: r.root for r in simhash.components(edges.select("a", "b")).collect()}
    got = {}
    for _, p in rows:
        got.setdefault(roots.get(p, p), set()).add(p & (1 << 64) - 1)
    want = {}
    for p, name in zip(prints, plain_components(prints, prints, budget)):
        want.setdefault(name, set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_chains_and_stars_contract(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 150)]
    edges = spark.createDataFrame(chain, "a long, b long")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 150)}


def test_a_large_group_reports_roots_not_pairs(spark):
    center = 0x0F0F_1234_5678_9ABC
    rows = [(0, center ^ (1 << i) ^ (1 << j)) for i in range(60) for j in range(i)]
    table = spark.createDataFrame(rows, "table int, print long")
    assert simhash._links(table, 2).count() <= 3 * len(rows)


def test_more_tables_link_more(messy):
    draw = random.Random(5)
    base = [f"w{draw.randrange(5000)}" for _ in range(300)]
    edited = list(base)
    for place in (40, 120, 250):
        edited[place] = "changed"
    other = [f"w{draw.randrange(5000)}" for _ in range(300)]
    rows = [(3, " ".join(base)), (4, " ".join(edited)), (5, " ".join(other)), (9, " ".join(base))]
    found = simhash.near_duplicates(messy(rows), ["doc_id"], 5, 4, tables=8).collect()
    names = {r.doc_id: r.component_id for r in found}
    assert names == {3: 3, 4: 3, 5: 5, 9: 3}


def test_independent_tables():
    prints = simhash.fingerprints_of("some words of a text that is long enough to tell", 3, 4)
    assert len(set(prints)) == 4
    apart = np.bitwise_count(np.array(prints[1:], np.uint64) ^ np.uint64(prints[0]))
    assert (apart > 10).all()
