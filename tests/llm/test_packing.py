"""Packing: whole documents, gapless sequences, few of them."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from veracast.llm import packing
from veracast.llm.tokens import encoder, tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def _check(found, rows, room, end):
    tokenizer = encoder(PATH).tokenizer
    pieces = defaultdict(list)
    for r in found:
        pieces[r.doc_id].append(r)
    for doc_id in {i for i, _ in rows}:
        texts = [t for i, t in rows if i == doc_id]
        want = []
        for text in texts:
            ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
            cuts = [0, *range((len(ids) - 1) % room + 1, len(ids) + 1, room)]
            want += [
                (i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
            ]
        got = [(r.piece, r.start, r.length, r.ids_crc32) for r in pieces[doc_id]]
        assert sorted(got) == sorted(want)
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= room
    return len(sequences)


def test_odd_rows(messy, odd_rows):
    found = packing.packed_sequences(messy(odd_rows), PATH, 2, 64).collect()
    _check(found, odd_rows, 64, 2)


def test_rounds_merge_underfull_bins(spark, messy, monkeypatch):
    monkeypatch.setattr(packing, "FAN_IN", 2)
    rows = [(i, "a " * (1 + i * 37 % 90)) for i in range(400)]
    found = packing.packed_sequences(messy(rows).repartition(8), PATH, 2, 100).collect()
    made = _check(found, rows, 100, 2)
    assert made <= 1.05 * sum(r.length for r in found) / 100


def test_equal_items_that_never_pair(messy):
    rows = [(i, "a " * 59) for i in range(50)]
    found = packing.packed_sequences(messy(rows), PATH, 2, 100).collect()
    assert _check(found, rows, 100, 2) == 50


def test_nothing(messy):
    assert packing.packed_sequences(messy([]), PATH, 2, 64).collect() == []


@given(st.lists(st.integers(1, 50), max_size=80))
@settings(max_examples=100, deadline=None)
def test_best_fit_is_valid(lengths):
    bins, offsets, used = packing.best_fit(np.array(lengths, dtype=np.int64), 50)
    for b in range(len(used)):
        parts = sorted((offsets[i], lengths[i]) for i in range(len(lengths)) if bins[i] == b)
        assert [o for o, _ in parts] == np.cumsum([0] + [n for _, n in parts])[:-1].tolist()
        assert sum(n for _, n in parts) == used[b] <= 50
    # Any two bins together exceed the room, or best fit would have joined them.
    assert all(a + b > 50 for i, a in enumerate(used) for b in used[:i])
