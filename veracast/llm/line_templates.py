"""Line dedup by a tree of line templates.

A line goes down a tree of fixed depth: by its number of tokens, then by its first ``LEADING``
tokens. A token with a digit counts as a variable field. In its leaf a line has one template with
all remaining tokens fixed and, if it has ``OPEN_TOKENS`` or more, ``SPANS`` templates that leave one
span of its tokens open, so that names and other fields without digits vary too. A template in
``min_docs`` or more documents recurs: its lines go, except in the document with the smallest id.

* Leaves with fewer documents than ``min_docs`` can't hold a recurring template; they are counted
  first, and only lines of the others have their templates counted. Both are counts of hashes,
  folded before the shuffle, so a line that a third of all documents share is no hot group; lines of
  crowded leaves, a bounded number of them, meet their leaf by broadcast.
* Documents are joined with the numbers of their lost lines; that is the one shuffle of texts.

Lines under ``min_tokens`` tokens, and lines of which half or more is variable, stay. A document may
lose all lines; it stays, with an empty text. Null text stays null. A row counts as a document, also
where rows share an id; a document without an id is never the first. Other columns are kept.
"""

from __future__ import annotations

import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import map_batches, row_key
from veracast.sources.scratch import stage

MIN_DOCS, MIN_TOKENS = 3, 3
LEADING, SPANS, OPEN_TOKENS = 2, 4, 8
_FIELD = "<*>"
_DIGIT = re.compile(r"\d")
_LINES = (
    "doc_id long, key long, line int, leaf long, leaf_first boolean,"
    " templates array<struct<template: long, first: boolean>>"
)
#: Leaves that are broadcast, at most.
MOST_CROWDED = 1_000


def line_paths(line: str, min_tokens: int = MIN_TOKENS) -> tuple[int, list[int]] | None:
    """Hashes of a line's leaf and of its templates there; none for a line that always stays."""
    tokens = line.split()
    if len(tokens) < min_tokens:
        return None
    if _DIGIT.search(line):
        tokens = [_FIELD if _DIGIT.search(t) else t for t in tokens]
        if 2 * tokens.count(_FIELD) >= len(tokens):
            return None
    n = len(tokens)
    shapes = [str(n) + "\x00" + "\x00".join(tokens[:LEADING]), "\x00".join(tokens)]
    if n >= OPEN_TOKENS:
        cuts = [LEADING + (n - LEADING) * i // SPANS for i in range(SPANS + 1)]
        shapes += [
            "\x00".join([*tokens[:a], f"{_FIELD}{b - a}", *tokens[b:]])
            for a, b in zip(cuts, cuts[1:])
        ]
    leaf, *templates = map(xxhash.xxh64_intdigest, (s.encode("utf-8", "replace") for s in shapes), repeat(0))
    signed = [h - (1 << 64) if h >> 63 else h for h in (leaf, *(t ^ leaf for t in templates))]
    return signed[0], signed[1:]


def _line_rows(docs: DataFrame, min_tokens: int) -> DataFrame:
    def build():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            # Flat arrays of numbers: a batch of texts has many more lines, and templates.
            places, numbers, leaves, ends = array("q"), array("i"), array("q"), array("i", [0])
            leaf_first, templates, first = bytearray(), array("q"), bytearray()
            for at, text in enumerate(batch.column(2).to_pylist()):
                seen: set[int] = set()
                for number, line in enumerate(text.split("\n")):
                    paths = line_paths(line, min_tokens)
                    if not paths:
                        continue
                    leaf, found = paths
                    places.append(at)
                    numbers.append(number)
                    leaves.append(leaf)
                    leaf_first.append(leaf not in seen)
                    templates.extend(found)
                    first.extend([t not in seen for t in found])
                    ends.append(len(templates))
                    seen.add(leaf)
                    seen.update(found)
            own = pa.array(np.frombuffer(places, dtype=np.int64))
            pairs = pa.StructArray.from_arrays(
                [_numbers(templates, np.int64), _flags(first)], ["template", "first"]
            )
            columns = [
                batch.column(0).take(own),
                batch.column(1).take(own),
                _numbers(numbers, np.int32),
                _numbers(leaves, np.int64),
                _flags(leaf_first),
                pa.ListArray.from_arrays(_numbers(ends, np.int32), pairs),
            ]
            names = ["doc_id", "key", "line", "leaf", "leaf_first", "templates"]
            return pa.RecordBatch.from_arrays(columns, names)

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key(docs).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return map_batches(rows, build, _LINES)


def _numbers(values: array, kind: type) -> pa.Array:
    return pa.array(np.frombuffer(values, dtype=kind))


def _flags(values: bytearray) -> pa.Array:
    return pa.array(np.frombuffer(values, dtype=np.uint8).astype(bool))


def _in_leaves(lines: DataFrame, min_docs: int) -> DataFrame:
    """The rows of ``lines`` whose leaf has ``min_docs`` documents.

    Leaves with more than a share of all lines, hence a bounded number of leaves, are broadcast, so
    that no task gets a leaf that many documents share; the others' lines are joined by leaf.
    """
    leaves = lines.groupBy("leaf").agg(F.sum(F.col("leaf_first").cast("int")).alias("docs"))
    crowded = max(min_docs, lines.count() // MOST_CROWDED)
    hot = F.broadcast(leaves.where(F.col("docs") > crowded).select("leaf"))
    rest = leaves.where(F.col("docs").between(min_docs, crowded)).select("leaf")
    others = lines.join(hot, "leaf", "left_anti").join(rest, "leaf", "left_semi")
    return lines.join(hot, "leaf", "left_semi").unionByName(others)


def lost_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(doc_id, key, lost): the sorted numbers of the lines that documents lose, if any."""
    lines = stage(_line_rows(docs, min_tokens), "line-templates")
    open_lines = stage(
        _in_leaves(lines, min_docs).select("doc_id", "key", "line", F.inline("templates")),
        "line-candidates",
    )
    recurring = (
        open_lines.groupBy("template")
        .agg(F.sum(F.col("first").cast("int")).alias("docs"), F.min("doc_id").alias("home"))
        .where(F.col("docs") >= min_docs)
        .select("template", "home")
    )
    # Written first, so that the join's two sides are plain shuffles: Spark then splits the rows of
    # a template that very many documents share.
    recurring = stage(recurring, "recurring-templates")
    elsewhere = F.col("home").isNotNull() & (
        F.col("doc_id").isNull() | (F.col("doc_id") > F.col("home"))
    )
    return (
        open_lines.join(recurring, "template")
        .where(elsewhere)
        .groupBy("doc_id", "key")
        .agg(F.array_sort(F.collect_set("line")).alias("lost"))
    )


def drop_recurring_lines(
    docs: DataFrame, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS
) -> DataFrame:
    """``docs`` without the lines lost, in columns ``row`` (all columns), ``text`` and ``lost``."""
    lost = lost_lines(docs, min_docs, min_tokens).withColumnsRenamed(
        {"doc_id": "lost_id", "key": "lost_key"}
    )
    whole = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.col("doc_id").cast("long").alias("own_id"),
        row_key(docs).alias("own_key"),
    )
    same = F.col("own_id").eqNullSafe(F.col("lost_id")) & (F.col("own_key") == F.col("lost_key"))
    # Named, so that a text is split once and its lines are then taken by their numbers.
    joined = whole.join(lost, same, "left").select(
        "row", "lost", F.split("row.text", "\n", -1).alias("lines")
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "lost")
    left = F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n")
    text = F.when(F.col("lost").isNull(), F.col("row.text")).otherwise(left)
    return joined.select("row", text.alias("text"), F.coalesce(F.size("lost"), F.lit(0)).alias("lost"))
