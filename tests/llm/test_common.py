"""Batches of texts: bounded in rows and bytes, every row once; the user's limits stay."""

from __future__ import annotations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veracast.llm import common


@given(st.lists(st.one_of(st.none(), st.integers(0, 60)), max_size=40), st.integers(1, 50), st.integers(1, 7))
@settings(max_examples=200, deadline=None)
def test_slices(sizes, most_bytes, most_rows):
    texts = [None if n is None else "é" * n for n in sizes]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(range(len(texts)))], ["t", "n"])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(common, "BATCH_BYTES", most_bytes)
        patch.setattr(common, "BATCH_ROWS", most_rows)
        parts = list(common.slices(batch))
    assert [n for p in parts for n in p.column(1).to_pylist()] == list(range(len(texts)))
    for part in parts:
        held = sum(len((t or "").encode()) for t in part.column(0).to_pylist())
        assert 1 <= part.num_rows <= most_rows and (part.num_rows == 1 or held <= most_bytes)


def test_limits_of_the_session_stay(spark):
    own = {k: spark.conf.get(k) for k in (common._ROWS, common._BYTES) if k in spark.conf.getAll}
    try:
        for key in (common._ROWS, common._BYTES):
            spark.conf.unset(key)
        spark.conf.set(common._ROWS, "10000")
        common.ready_workers(spark)
        assert common._BYTES not in spark.conf.getAll and spark.conf.get(common._ROWS) == "10000"
        spark.conf.unset(common._ROWS)
        common.ready_workers(spark)
        assert spark.conf.get(common._BYTES) == str(4 * common.BATCH_BYTES)
    finally:
        spark.conf.unset(common._ROWS)
        for key, value in own.items():
            spark.conf.set(key, value)
