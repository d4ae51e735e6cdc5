"""The operators of this package over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import functions as F

from veracast.llm.alignment import alignment
from veracast.llm.common import bucket, table
from veracast.llm.conversation_repair import damaged, repair_report
from veracast.llm.credentials import credential_spans
from veracast.llm.decontamination import contamination
from veracast.llm.line_templates import drop_recurring_lines
from veracast.llm.mtree import integer_vectors, top_inner_products
from veracast.llm.oracles import ORACLE_SQL
from veracast.llm.packing import packed_sequences
from veracast.llm.prefix_table import encoded_and_decoded
from veracast.llm.quality import quality
from veracast.llm.simhash import hex_fingerprint, near_duplicates
from veracast.llm.surrogates import replace_entities
from veracast.llm.token_files import token_files
from veracast.llm.tokens import tokenizer_path
from veracast.llm.toxicity import toxicity

#: A score from here on counts as the label.
THRESHOLD = 0.3
#: In production a secret of the cluster; here fixed, so that runs agree.
SURROGATE_KEY = b"surrogates of the test tables"


def _judged(scores, held_out):
    return scores.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def op1_toxicity_ftrl(spark, sf_dir):
    held_out = bucket(F.col("doc_id"), 4) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _judged(toxicity(docs, table(spark, sf_dir, "labels"), ~held_out), held_out)


def op2_line_templates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = drop_recurring_lines(docs)
    return found.select("row.doc_id", "text", F.col("lost").cast("long").alias("n_dropped"))


def op3_simhash_trie(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    found = near_duplicates(docs, ["doc_id"], shingle=3, budget=2)
    fingerprint = hex_fingerprint(F.element_at("prints", 1)).alias("fingerprint")
    return found.select("doc_id", fingerprint, "component_id")


def op4_addressable_token_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


def op5_quality_fourier_ridge(spark, sf_dir):
    held_out = bucket(F.col("doc_id"), 5) == 0
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _judged(quality(docs, table(spark, sf_dir, "labels"), ~held_out), held_out)


def op6_best_fit_packing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packed_sequences(docs, tokenizer_path("byte_bpe_50k.json"), end_id=2, room=1024)


def op7_prefix_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long"), "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op8_mtree_top_products(spark, sf_dir):
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"), scale=1024)
    return top_inner_products(vectors, F.col("vec_id") % 100 == 0, k=10)


def op9_credential_spans(spark, sf_dir):
    return credential_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_pii_surrogates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, SURROGATE_KEY)


def op11_prefix_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded_and_decoded(docs, tokenizer_path("piece_bpe_32k.model"))


def op12_checkpointed_repair(spark, sf_dir):
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(damaged(conversations), conversations)


def op13_diagonal_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return alignment(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


QUERIES = {
    name: build for name, build in list(globals().items()) if name.startswith("op") and "_" in name
}
ORACLES = ORACLE_SQL
