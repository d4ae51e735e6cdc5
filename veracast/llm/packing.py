"""Hierarchical residual packing: documents into as few sequences of bounded length as possible.

A document's ids are cut from its end, so that only its first piece may be shorter than a
sequence. Pieces are dealt evenly to leaves by their count, not by files or cores, so what comes
out does not depend on how the documents are stored. Each leaf packs its pieces best-fit, longest
first; nearly full bins are closed, underfull bins go on as items, in an eighth of the groups, until
one group is left.

Before each round a histogram of the open bins' sizes (as many rows as a sequence has places) tells
which of them the smallest open bin doesn't fit any more: they are closed too, so that bins over half
full don't travel for nothing. A task packs at most ``MOST_ITEMS`` bins; where more stay open than the
groups before it could hold, the tree ends there: each group has at most one bin left that is no more
than half full, so at most one sequence a group is lost. Every bin of every round is kept and
numbered, so nothing depends on how often a round ran.

Pieces are staged with their checksums: texts are read and encoded once and never shuffled, and a
round moves only (bin, used). Null text counts as empty and still has its end id. Rows that share
an id are packed each by itself. An empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import in_arrow, map_batches
from veracast.llm.tokens import encoder
from veracast.sources.scratch import stage

#: A bin with this few places left isn't offered again.
NEARLY_FULL = 4
#: Pieces that a leaf packs, at least where there are so many, and bins of a task of later rounds.
LEAF_ITEMS, MOST_ITEMS = 50_000, 500_000
#: Groups whose underfull bins one task packs in the next round.
FAN_IN = 8
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str, end_id: int, room: int) -> DataFrame:
    """Every piece of every document: doc_id, piece, start, length, ids_crc32."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def build():
        encode = encoder(tokenizer).encode

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = encode(text) + end
                n = len(raw) // 4
                cuts = [0, *range((n - 1) % room + 1, n + 1, room)]
                out += [
                    (doc_id, i, a, b - a, zlib.crc32(raw[4 * a : 4 * b]))
                    for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
                ]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PIECES.split(", ")])

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return map_batches(rows, build, _PIECES)


def best_fit(lengths: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per item: bin, offset in it; per bin: places used. Longest items first, tightest bin."""
    bins = np.zeros(len(lengths), dtype=np.int64)
    offsets = np.zeros(len(lengths), dtype=np.int64)
    used: list[int] = []
    # Bins by the places they have left; bit f of ``there`` is set if some bin has f left.
    left: list[list[int]] = [[] for _ in range(room + 1)]
    there = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = there >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            at = left[free].pop()
            if not left[free]:
                there &= ~(1 << free)
        else:
            free, at = room, len(used)
            used.append(0)
        bins[i], offsets[i] = at, used[at]
        used[at] += size
        if free > size:
            left[free - size].append(at)
            there |= 1 << (free - size)
    return bins, offsets, np.array(used, dtype=np.int64)


def _round(items: DataFrame, number: int, room: int, length: str, names: list[str]) -> DataFrame:
    """``items`` with bin, offset, and the bin's use on the row that opens it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        bins, offsets, used = best_fit(rows.column(length).to_numpy(), room)
        first = (number << 58) + (TaskContext.get().partitionId() << 34)
        full = np.where(offsets == 0, used[bins], 0)
        for name, values in (("bin", first + bins), ("offset", offsets), ("used", full)):
            rows = rows.append_column(name, pa.array(values, pa.int64()))
        yield from rows.to_batches(max_chunksize=65536)

    kinds = ", ".join(f"{n} {dict(items.dtypes)[n]}" for n in names)
    schema = f"{kinds}, bin bigint, offset bigint, used bigint"
    return stage(in_arrow(items.select(*names), run, schema), f"packing-{number}")


def _still_open(current: DataFrame, room: int) -> tuple[DataFrame, int]:
    """Bins (was, length) that another open bin may fit, and how many they are."""
    open_bins = current.where((F.col("used") > 0) & (F.col("used") < room - NEARLY_FULL))
    sizes = {r["used"]: r["count"] for r in open_bins.groupBy("used").count().collect()}
    if sum(sizes.values()) < 2:
        return open_bins, 0
    least = min(sizes)
    # The smallest bin itself needs another one.
    second = least if sizes[least] > 1 else min(s for s in sizes if s != least)
    if least + second > room:
        return open_bins, 0
    found = sum(n for size, n in sizes.items() if size + least <= room)
    fitting = open_bins.where(F.col("used") <= room - least)
    return fitting.select(F.col("bin").alias("was"), F.col("used").alias("length")), found


def pack(cut: DataFrame, room: int) -> DataFrame:
    """``cut`` (with length, 1 to ``room``) with sequence_id and offset.

    An item's length is its number of places; items keep together.
    """
    cut = stage(cut, "pieces")
    groups = max(1, math.ceil(cut.count() / LEAF_ITEMS))
    placed = _round(cut.repartition(groups), 0, room, "length", cut.columns)
    moves, current, number = None, placed, 0
    while groups > 1:
        items, found = _still_open(current, room)
        fewer = max(math.ceil(groups / FAN_IN), math.ceil(found / MOST_ITEMS))
        if not found or fewer >= groups:
            break
        groups, number = fewer, number + 1
        current = _round(items.repartition(groups), number, room, "length", ["was", "length"])
        step = current.select("was", F.col("bin").alias("now"), F.col("offset").alias("shift"))
        if moves is None:
            moves = step.withColumnRenamed("was", "bin")
            continue
        after = step.select(
            F.col("was").alias("now"), F.col("now").alias("then"), F.col("shift").alias("more")
        )
        moves = stage(
            moves.join(after, "now", "left").select(
                "bin",
                F.coalesce("then", "now").alias("now"),
                (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"),
            ),
            "moves",
        )
    if moves is None:
        return placed.select(*cut.columns, F.col("bin").alias("sequence_id"), "offset")
    return placed.join(moves, "bin", "left").select(
        *cut.columns,
        F.coalesce("now", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )


def packed_sequences(docs: DataFrame, tokenizer: str, end_id: int, room: int) -> DataFrame:
    return pack(pieces(docs, tokenizer, end_id, room), room)
