"""The pipeline against a brute-force version, and its stages on odd rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veracast.llm import queries
from veracast.sources.scratch import stage

from .test_decontamination import plain as plain_contamination
from .test_line_templates import plain as plain_lines
from .test_packing import _check
from .test_similar import plain as plain_similar

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def tables(spark, messy, odd_rows, write_tables):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "an item of a benchmark that has more than ten words in it")], "item_id long, text string")
    return write_tables(documents=messy(odd_rows), labels=labels, benchmark=items)


def test_stages_on_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    held = sorted((r.doc_id, r.text) for r in docs.collect())
    columns = docs.columns

    def step(name):
        nonlocal docs
        docs = stage(STAGES[name](spark, docs, sf_dir), "test-stage")
        return sorted((r.doc_id, r.text) for r in docs.collect()) if "text" in docs.columns else None

    scores = queries.QUERIES["op5_quality_fourier_ridge"](spark, sf_dir)
    good = {r.doc_id for r in scores.where(F.col("score") >= 0.3).collect()}
    held = [r for r in held if r[0] in good]
    assert step("quality") == held
    held = plain_lines(held)
    assert step("line dedup") == sorted(held)
    assert docs.where("n_chars <> length(text)").count() == 0
    held = plain_similar(sorted(held))
    assert step("near-dedup") == held
    marked = {r[0] for r in plain_contamination(held, items) if r[2]}
    assert marked
    held = [r for r in held if r[0] not in marked]
    assert step("decontamination") == held
    assert docs.columns == columns
    step("packing")
    _check(docs.collect(), held, 1024, 2)
    whole = corpus_pipeline.run(spark, sf_dir).drop("sequence_id", "offset")
    assert sorted(whole.collect()) == sorted(docs.drop("sequence_id", "offset").collect())


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_odd_rows(spark, tables, name):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    kept = STAGES[name](spark, docs, tables)
    assert kept.columns == docs.columns
    n = docs.count()
    # Two repeated rows, three texts without words, and two rows without id and text are copies.
    assert kept.count() == (n if name != "near-dedup" else 6)
    assert STAGES[name](spark, docs.limit(0), tables).collect() == []


def test_empty_tables_pass_through(spark, messy, write_tables):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    folder = write_tables(documents=messy([]), labels=labels, benchmark=items)
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {f"op{i}" for i in range(1, 14)} <= {n.split("_")[0] for n in names}
    assert set(__spark_entry__.oracle_sql()) <= names
