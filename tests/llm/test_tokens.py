"""Encoder, directly addressable codes and token files against the tokenizer itself."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veracast.llm import dac, token_files
from veracast.llm.tokens import PieceEncoder, Recent, encoder, tokenizer_path

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
TRICKY = st.text(st.sampled_from("aBz é'É\n.,!1t\tß½ \x00\x01\x0b ́Σσ🎉<|>"), max_size=40)


@pytest.mark.parametrize("name", FILES)
@given(text=st.one_of(TRICKY, st.text(max_size=60)))
@settings(max_examples=300, deadline=None)
def test_encoder_equals_tokenizer(name, text):
    found = encoder(tokenizer_path(name))
    want = found.tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(found.encode(text), "<u4").tolist() == want


@pytest.mark.parametrize("name", FILES)
def test_plain_word_is_kept_once(name):
    """A word alone is its own piece; with marks after it, the word's ids are taken from there."""
    made = PieceEncoder(tokenizer_path(name))
    made.encode("start overly overly, overly.")
    kept = [key for c in vars(made).values() if isinstance(c, Recent) for key in c]
    assert [key.strip() for key in kept].count("overly") == 1


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 60_000), max_size=700), st.data())
@settings(max_examples=120, deadline=None)
def test_codes_give_random_access(ids, data):
    segment = dac.Segment(dac.encode(np.array(ids, dtype=np.uint32)))
    assert segment.tokens(0, len(ids)).tolist() == ids
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert segment.tokens(a, b).tolist() == ids[a:b]
    if a < len(ids):
        assert segment.token(a) == ids[a]


def test_codes_refuse_places_outside():
    segment = dac.Segment(dac.encode(np.array([5, 300], dtype=np.uint32)))
    for place in (-1, 2):
        with pytest.raises(IndexError):
            segment.token(place)
    with pytest.raises(ValueError):
        dac.Segment(b"nothing of the kind")


def _expected(rows, name, end):
    tokenizer = encoder(tokenizer_path(name)).tokenizer
    out, start = [], 0
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_in_order(messy, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_TOKENS", 40)
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(300)] + [(300, None)]
    path = tokenizer_path(FILES[0])
    found = token_files.token_files(messy(rows).repartition(5), path, end_id=1).collect()
    assert sorted(map(tuple, found)) == _expected(rows, FILES[0], 1)


def test_token_files_of_odd_rows(messy, odd_rows):
    found = token_files.token_files(messy(odd_rows), tokenizer_path(FILES[0]), end_id=1).collect()
    assert len(found) == len(odd_rows)
    want = _expected(odd_rows, FILES[0], 1)
    assert sorted(str((r.doc_id, r.n_tokens, r.ids_crc32)) for r in found) == sorted(
        str((i, n, c)) for i, _, n, c in want
    )
    by_start = sorted(found, key=lambda r: r.start)
    assert [r.start for r in by_start] == np.cumsum([0, *(r.n_tokens for r in by_start)])[:-1].tolist()
    ids = [r.doc_id for r in by_start]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))


def test_token_files_of_nothing(messy):
    assert token_files.token_files(messy([]), tokenizer_path(FILES[0]), end_id=1).collect() == []
