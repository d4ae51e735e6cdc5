"""A corpus pipeline of five operators: from documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of ``docs``. A stage works on every row that its predecessor kept, and what it decides takes effect:
rejected documents, lost lines, copies and contaminated documents are gone for the next one.

Null text counts as empty in every stage. An empty table passes through. Columns besides doc_id and
text go along unchanged, but ``n_chars`` follows its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veracast.llm.common import bucket, row_key, table
from veracast.llm.decontamination import contamination
from veracast.llm.line_templates import drop_recurring_lines
from veracast.llm.packing import packed_sequences
from veracast.llm.quality import keep_good
from veracast.llm.similar import similar_groups
from veracast.llm.tokens import tokenizer_path
from veracast.sources.scratch import stage

#: Documents scored below are rejected.
LEAST_QUALITY = 0.3
#: Copies have this Jaccard similarity, or more, of their shingles of five words.
SHINGLE, LEAST_SIMILAR = 5, 0.8

# SQL has no counterpart of the trained classifier; tests compare with a brute-force version.
ORACLE_SQL = None


def _place(df: DataFrame) -> list[Column]:
    """Never null, and with the text's hash different for rows that differ in id or text."""
    return [
        F.struct(
            df["doc_id"].isNull().alias("missing"),
            F.coalesce(df["doc_id"].cast("long"), F.lit(0)).alias("id"),
            row_key(df).alias("key"),
        ).alias("place")
    ]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score isn't low."""
    usable = bucket(F.col("doc_id"), 5) != 0
    return keep_good(docs, table(spark, sf_dir, "labels"), usable, LEAST_QUALITY)


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without lines whose template recurs in others before it."""
    found = drop_recurring_lines(docs)
    text = F.col("text")
    kept = {c: F.col(f"row.`{c}`").alias(c) for c in docs.columns} | {"text": text.alias("text")}
    if "n_chars" in kept:
        kind = docs.schema["n_chars"].dataType
        kept["n_chars"] = F.when(F.col("lost") == 0, kept["n_chars"]).otherwise(
            F.length(text).cast(kind)
        ).alias("n_chars")
    return found.select(*kept.values())


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    found = similar_groups(docs.select(*_place(docs), F.col("text")), SHINGLE, LEAST_SIMILAR)
    stay = found.groupBy("root").agg(F.min("place").alias("place")).select("place")
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *_place(docs))
    kept = row.join(stage(stay, "documents-that-stay"), "place", "left_semi")
    # Rows that repeat both id and text are copies as well.
    again = Window.partitionBy("place").orderBy(F.xxhash64("row"))
    first = kept.withColumn("again", F.row_number().over(again)).where("again = 1")
    return first.select("row.*")


def without_benchmark_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    benchmark = table(spark, sf_dir, "benchmark").select("item_id", "text")
    bad = contamination(docs.select("doc_id", "text"), benchmark).where("n_hit > 0")
    bad = bad.select(
        F.struct(
            F.col("doc_id").isNull().alias("missing"),
            F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
            F.col("key"),
        ).alias("place")
    )
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *_place(docs))
    return row.join(bad, "place", "left_anti").select("row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in sequences of 1024 tokens."""
    path = tokenizer_path("byte_bpe_50k.json")
    return packed_sequences(docs.select("doc_id", "text"), path, end_id=2, room=1024)


STAGES = [
    ("quality", good_quality),
    ("line dedup", without_recurring_lines),
    ("near-dedup", one_of_each_group),
    ("decontamination", without_benchmark_text),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    *inner, (_, last) = STAGES
    for name, step in inner:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
