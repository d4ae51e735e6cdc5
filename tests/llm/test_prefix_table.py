"""The prefix table against the library's own ids and texts."""

from __future__ import annotations

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veracast.llm import prefix_table, queries, tokens
from veracast.llm.prefix_table import Merges, cuts
from veracast.llm.tokens import tokenizer_path

MODEL = tokenizer_path("piece_bpe_32k.model")
TABLE = prefix_table.prefix_table(MODEL)
TRICKY = st.text(st.sampled_from("ab thetion▁  \n\t\0éß日本ゼ梦🎉<0xA>s/.,²·1234567890'´"), max_size=60)


@given(st.one_of(TRICKY, st.text(max_size=80)))
@settings(max_examples=600, deadline=None)
def test_ids_equal_the_library(text):
    assert TABLE.encode(text) == TABLE.library.encode(text)


@pytest.mark.parametrize("text", [" " * 3_000, "a" * 50_000, "ab" * 20_000, "\n" * 5_000, "🎉" * 4_000, "x" + " " * 999])
def test_long_runs(text):
    assert TABLE.encode(text) == TABLE.library.encode(text)


def test_last_tokens_name_every_prefix():
    text = "▁international▁understandings"
    last = TABLE.last_tokens(text)
    for end in range(1, len(text) + 1):
        parts, _ = TABLE.merges.joined(text[:end])
        assert TABLE.pieces[last[end]] == parts[-1]


@given(
    st.dictionaries(st.text("abc", min_size=2, max_size=4), st.integers(-4, 0), max_size=14),
    st.text("abc", max_size=9),
)
@settings(max_examples=400, deadline=None)
def test_compatible_tokens_are_the_encoding(scores, text):
    """For any pieces and scores, ties included: exactly one row of compatible tokens is a text."""
    merges = Merges({c: 0.0 for c in "abc"} | scores)
    usable = [p for p in merges.scores if merges.history(p) is not None]
    rows = {0: [[]]}
    for end in range(1, len(text) + 1):
        rows[end] = [
            row + [p]
            for p in usable
            if text[:end].endswith(p)
            for row in rows[end - len(p)]
            if not row or merges.compatible(row[-1], p)
        ]
    assert rows[len(text)] == [merges.joined(text)[0]]


@given(TRICKY)
@settings(max_examples=200, deadline=None)
def test_cuts_cover_the_text(text):
    text = text.replace(" ", "▁")
    assert "".join(TABLE.cuts.findall(text)) == text


def test_cuts_refuse_pieces_across_blanks():
    with pytest.raises(ValueError):
        cuts({"a▁b"})


def test_recent_values_return(monkeypatch):
    made = []
    kept = tokens.Recent(lambda key: made.append(key) or key, 4)
    for key in "aabacadaeafaga":
        assert kept[key] == key
    assert made.count("a") == 1 and len(kept) <= 2
    long = "x" * (tokens.CACHE_CHARS + 1)
    assert kept[long] == long and long not in kept


def _want(rows):
    for doc_id, text in rows:
        ids = TABLE.library.encode(text or "")
        shown = ",".join(map(str, ids)), TABLE.library.decode(ids)
        yield doc_id, len(ids), *(hashlib.sha256(s.encode()).hexdigest() for s in shown)


def test_odd_rows(messy, odd_rows, write_tables, spark):
    folder = write_tables(documents=messy(odd_rows))
    found = queries.op11_prefix_table(spark, folder).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, _want(odd_rows)))


def test_given_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op11_prefix_table(spark, sf_dir).collect())) == sorted(_want(rows))


def test_nothing(messy, write_tables, spark):
    folder = write_tables(documents=messy([]))
    assert queries.op11_prefix_table(spark, folder).collect() == []
