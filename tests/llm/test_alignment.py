"""Alignment of two tokenizers against sets of shared ends and plain counts."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veracast.llm import alignment, queries
from veracast.llm.tokens import encoder, tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
ALIGNER = alignment.aligner(*PATHS)
TRICKY = st.text(st.sampled_from("ab thetion  \n\t\0éß日本ゼ🎉<|endoftext|>.,²1'´"), max_size=60)


@st.composite
def two_cuts(draw):
    n = draw(st.integers(1, 120))
    common = draw(st.sets(st.integers(1, n), max_size=n))
    return [
        sorted(common | draw(st.sets(st.integers(1, n), max_size=draw(st.integers(0, 12)))) | {n})
        for _ in "ab"
    ]


@given(two_cuts())
@settings(max_examples=500, deadline=None)
def test_runs_and_groups(cuts):
    a, b = cuts
    runs, groups = alignment.aligned(a, b)
    found = [(i + k, i + k + 1, j + k, j + k + 1) for i, j, n in runs for k in range(n)] + groups
    want, i, j = [], 0, 0
    for end in sorted(set(a) & set(b)):
        x, y = a.index(end) + 1, b.index(end) + 1
        want.append((i, x, j, y))
        i, j = x, y
    assert sorted(found) == want
    assert all((x - i, y - j) != (1, 1) for i, x, j, y in groups)


def test_long_runs_need_few_comparisons():
    class Counted(list):
        reads = 0

        def __getitem__(self, at):
            Counted.reads += 1
            return list.__getitem__(self, at)

    a = Counted(range(1, 100_001))
    b = Counted([*range(1, 70_000), *range(70_001, 100_001)])
    assert alignment.aligned(a, b) == (
        [(0, 0, 69_999), (70_001, 70_000, 29_999)],
        [(69_999, 70_001, 69_999, 70_000)],
    )
    assert Counted.reads < 250


def plain(text):
    """Ids of both, and the groups as lists of ids."""
    if not text:
        return [], [], []
    spelt = b" " + text.encode()
    a = encoder(PATHS[0]).tokenizer.encode(" " + text, add_special_tokens=False).ids
    b = alignment.prefix_table(PATHS[1]).library.encode(text)
    shown_a, shown_b = [ALIGNER.bytes_a[i] for i in a], [ALIGNER.bytes_b[i] for i in b]
    if b"".join(shown_a) != spelt or b"".join(shown_b) != spelt:
        return [], [], []
    ends_a, ends_b = (list(accumulate(map(len, s))) for s in (shown_a, shown_b))
    at_a, at_b = ({end: k + 1 for k, end in enumerate(ends)} for ends in (ends_a, ends_b))
    groups, i, j = [], 0, 0
    for end in sorted(at_a.keys() & at_b.keys()):
        x, y = at_a[end], at_b[end]
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return a, b, groups


def plain_rows(rows):
    docs, held = [], Counter()
    for doc_id, text in rows:
        a, b, groups = plain(text)
        links = Counter((x, y) for of_a, of_b in groups for x in of_a for y in of_b)
        held.update(links.keys())
        docs.append((doc_id, a, b, groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for doc_id, a, b, groups, links in docs:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (
            doc_id,
            len(a),
            len(b),
            len(groups),
            sum(links.values()),
            sum(n for p, n in links.items() if held[p] == most[p[0]]),
            sum(n * held[p] for p, n in links.items()),
            hashlib.sha256(shown.encode()).hexdigest() if a else "",
        )


@given(st.lists(st.one_of(st.none(), TRICKY, st.text(max_size=80)), min_size=1, max_size=4))
@settings(max_examples=300, deadline=None)
def test_batches_of_documents(texts):
    *sizes, digests, (starts, pairs, times) = ALIGNER.batch(texts)
    for i, text in enumerate(texts):
        (want,) = plain_rows([(0, text)])
        assert [int(s[i]) for s in sizes] == list(want[1:5]) and digests[i] == want[-1]
        links = Counter((x, y) for of_a, of_b in plain(text)[2] for x in of_a for y in of_b)
        own = slice(starts[i], starts[i + 1])
        assert {divmod(p, ALIGNER.width): n for p, n in zip(pairs[own].tolist(), times[own].tolist())} == links


def test_large_groups_are_linked_by_distinct_ids():
    a, b = np.array([7] + [5] * 90 + [6] * 20), np.array([3] * 71)
    one = np.array
    starts, pairs, times = ALIGNER._pairs(
        a, b, one([0, 1]), one([1, 110]), one([0, 1]), one([1, 70]), one([0, 1]), 2
    )
    assert starts.tolist() == [0, 1, 3]
    assert dict(zip(pairs.tolist(), times.tolist())) == {
        7 * ALIGNER.width + 3: 1,
        5 * ALIGNER.width + 3: 6300,
        6 * ALIGNER.width + 3: 1400,
    }


def _found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_given_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(plain_rows(map(tuple, rows)), key=str)
    assert _found(queries.op13_diagonal_alignment(spark, sf_dir)) == want


@pytest.mark.parametrize("bound", [0, 3, 60])
def test_odd_rows_whatever_is_broadcast(messy, odd_rows, bound):
    rows = [*odd_rows, (20, "▁ is a blank for one of them"), (21, "日本 🎉" * 40), (22, "a" * 5_000)]
    found = _found(alignment.alignment(messy(rows).repartition(3), *PATHS, bound=bound))
    assert found == sorted(plain_rows(rows), key=str)


def test_nothing(messy):
    assert alignment.alignment(messy([]), *PATHS).collect() == []
