"""Cross-tokenizer alignment: which tokens of two encodings stand for the same bytes.

Both encodings spell one byte string; places where tokens of both end cut it into groups. Tokens of
two tokenizers mostly agree one to one, so the end arrays are equal over long runs once one of
them is shifted:

* **Runs.** At the current shift, slices of the two end arrays are compared, each twice as long as
  the one before, until they differ; halving finds the place. Everything up to it is jumped.
* **Irregular groups.** Where ends differ, the smaller one moves on until both agree. That group's
  sizes give the new shift.

A pair of token ids is linked wherever its tokens share a group. How many documents hold a linked
pair is counted over the corpus; each document then looks its pairs up. Documents are written once
with their distinct pairs, and only pairs are dealt out: those in most documents, a bounded number
found by a histogram of counts, are broadcast, so that a pair that a third of all documents hold is
no hot key; the rest are joined by shuffle.

Groups of many tokens are linked by their distinct ids with counts, so that a group of n and m equal
tokens makes one pair. Null and empty texts, and texts that one of the tokenizers doesn't spell
(the second writes a blank for U+2581), have no tokens. Rows that share an id are aligned and counted
each by itself. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from veracast.llm.common import map_batches
from veracast.llm.prefix_table import BLANK, prefix_table
from veracast.llm.tokens import OTHER_SPACE, Recent, byte_letters, encoder
from veracast.sources.scratch import stage

#: Pairs whose counts are broadcast: about 10 MB.
BROADCAST_PAIRS = 200_000
#: Links of a group that are made one by one.
SMALL_GROUP = 256
#: Units of text whose tokens a worker keeps.
UNIT_LIMIT = 300_000
#: White space that isn't cut as both tokenizers do.
RUNS = ("  ", " \n", "\n ", "\n\n")

#: A run of one-to-one groups from tokens i and j on, or one group of tokens [i, x) and [j, y).
Group = tuple[int, int, int, int]


def aligned(a: list[int], b: list[int]) -> tuple[list[tuple[int, int, int]], list[Group]]:
    """Runs (i, j, groups) and irregular groups (i, x, j, y) of two arrays of ends with one last value."""
    runs, groups = [], []
    i = j = 0
    n = len(a)
    while i < n:
        if a[i] == b[j]:
            # At this shift, slices of twice the length each, until they differ.
            known, step = 1, 1
            p, q = i + 1, j + 1
            while p < n and a[p : p + step] == b[q : q + step]:
                known += step
                p, q, step = p + step, q + step, 2 * step
            # Then halves, to where they do.
            while step > 1 and p < n:
                step //= 2
                if a[p : p + step] == b[q : q + step]:
                    known += step
                    p, q = p + step, q + step
            known = min(known, n - i)
            runs.append((i, j, known))
            i, j = i + known, j + known
            if i >= n:
                break
        x, y = i, j
        end_a, end_b = a[x], b[y]
        while end_a != end_b:
            if end_a < end_b:
                x += 1
                end_a = a[x]
            else:
                y += 1
                end_b = b[y]
        if (x, y) != (i, j):
            groups.append((i, x + 1, j, y + 1))
            i, j = x + 1, y + 1
    return runs, groups


def _spellings(model_a: str, model_b: str) -> tuple[list[bytes], list[bytes]]:
    """The bytes of each token id of both tokenizers."""
    letters = {letter: b for b, letter in enumerate(byte_letters())}
    vocabulary = encoder(model_a).tokenizer.get_vocab(with_added_tokens=True)
    first = [b""] * (max(vocabulary.values()) + 1)
    for piece, i in vocabulary.items():
        if all(c in letters for c in piece):
            first[i] = bytes(letters[c] for c in piece)
    table = prefix_table(model_b)
    values = {i: b for b, i in enumerate(table.bytes)}
    second = [
        bytes([values[i]]) if i in values else piece.replace(BLANK, " ").encode()
        for i, piece in enumerate(table.pieces)
    ]
    return first, second


class Aligner:
    """Tokens, groups and linked pairs of texts."""

    def __init__(self, model_a: str, model_b: str):
        self.encoder, self.table = encoder(model_a), prefix_table(model_b)
        self.bytes_a, self.bytes_b = _spellings(model_a, model_b)
        self.sizes_a, self.sizes_b = (
            np.array([len(s) for s in spelt], dtype=np.int64) for spelt in (self.bytes_a, self.bytes_b)
        )
        #: A pair (a, b) is the number a * width + b.
        self.width = len(self.bytes_b)
        self.shown = [f"{i}{mark}" for i in range(max(len(self.bytes_a), self.width)) for mark in ",|;"]
        #: Both cut a text before single blanks, around line feeds and between a word and marks, so
        #: these units are encoded one by one.
        self.by_unit = self.encoder.kind == "spaced" and "\n" not in "".join(self.table.merges.scores)
        if not self.encoder.kind:
            raise ValueError("the first tokenizer has to be a byte-level one that changes nothing")
        self.units = Recent(self._unit, UNIT_LIMIT)

    def _spelt_by_b(self, spelt: str, ids: list[int]) -> bool:
        """Whether the second's tokens spell the text; the first's always do, byte by byte."""
        return b"".join(map(self.bytes_b.__getitem__, ids)) == spelt.encode()

    def _unit(self, unit: str) -> tuple[bytes, bytes] | None:
        """Tokens of a part of a text, its blank written as U+2581."""
        library, spelt = self.table.library, unit.replace(BLANK, " ")
        if unit[0] == BLANK:  # the library puts it there
            ids = library.encode(unit[1:])
        else:  # after a line feed, which no piece holds, as if in mid-text
            ids = library.encode("\n" + unit)[2:]
        if not self._spelt_by_b(spelt, ids):
            return None
        return self.encoder.piece(spelt), array("I", ids).tobytes()

    def tokens(self, text: str | None) -> tuple[bytes, bytes]:
        """Ids of both as little-endian unsigned 32-bit numbers; none if one doesn't spell the text."""
        if not text:
            return b"", b""
        spelt = " " + text
        whole = not self.by_unit or BLANK in text or text[-1] in " \n" or any(run in spelt for run in RUNS)
        if whole or OTHER_SPACE.search(text):
            ids = self.table.library.encode(text)
            if not self._spelt_by_b(spelt, ids):
                return b"", b""
            return self.encoder.encode(spelt), np.array(ids, "<u4").tobytes()
        found = list(map(self.units.__getitem__, self.table.cuts.findall(spelt.replace(" ", BLANK))))
        if None in found:
            return b"", b""
        of_a, of_b = zip(*found)
        return b"".join(of_a), b"".join(of_b)

    def batch(self, texts: list[str | None]):
        """Per text: n_a, n_b, n_groups, n_links, digests, and (starts, pairs, times) of distinct pairs.

        The texts' arrays are one after the other: a text ends with an end of both, so runs may
        go on from one text into the next.
        """
        of_a, of_b = zip(*map(self.tokens, texts))
        a, b = (np.frombuffer(b"".join(ids), "<u4").astype(np.int64) for ids in (of_a, of_b))
        from_a, from_b = (np.cumsum([0, *(len(ids) // 4 for ids in of)]) for of in (of_a, of_b))
        runs, groups = aligned(self.sizes_a[a].cumsum().tolist(), self.sizes_b[b].cumsum().tolist())
        last_a, last_b = self._last_tokens(len(a), len(b), runs, groups)
        ends_a, ends_b = np.flatnonzero(last_a), np.flatnonzero(last_b)
        starts_a, starts_b = (np.r_[0, ends[:-1] + 1][: len(ends)] for ends in (ends_a, ends_b))
        n_a, n_b = ends_a - starts_a + 1, ends_b - starts_b + 1
        from_group = np.searchsorted(ends_a, from_a)
        n_links = np.diff(np.r_[0, (n_a * n_b).cumsum()][from_group])
        digests = self._digests(a, b, last_a, last_b, ends_a, starts_b, from_a + from_b)
        doc = np.repeat(np.arange(len(texts)), np.diff(from_group))
        distinct = self._pairs(a, b, starts_a, n_a, starts_b, n_b, doc, len(texts))
        return np.diff(from_a), np.diff(from_b), np.diff(from_group), n_links, digests, distinct

    @staticmethod
    def _last_tokens(size_a: int, size_b: int, runs, groups) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens of both are the last of their group."""
        last_a, last_b = np.zeros(size_a, bool), np.zeros(size_b, bool)
        if runs:
            i, j, n = np.array(runs, dtype=np.int64).T
            places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            last_a[np.repeat(i, n) + places] = True
            last_b[np.repeat(j, n) + places] = True
        if groups:
            _, x, _, y = np.array(groups, dtype=np.int64).T
            last_a[x - 1] = True
            last_b[y - 1] = True
        return last_a, last_b

    def _digests(self, a, b, last_a, last_b, ends_a, starts_b, bounds) -> list[str]:
        """Of the groups as text: each id with the mark after it, a group's first ids before its second."""
        codes = np.empty(len(a) + len(b), dtype=np.int64)
        group_a, group_b = last_a.cumsum() - last_a, last_b.cumsum() - last_b
        codes[np.arange(len(a)) + starts_b[group_a]] = 3 * a + last_a
        codes[np.arange(len(b)) + ends_a[group_b] + 1] = 3 * b + 2 * last_b
        told = list(map(self.shown.__getitem__, codes.tolist()))
        out = []
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            text = "".join(told[first:last])[:-1]
            out.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
        return out

    def _pairs(self, a, b, starts_a, n_a, starts_b, n_b, doc, n_docs: int):
        """(starts, pairs, times): each document's distinct linked pairs and how often they are linked."""
        space = len(self.bytes_a) * self.width
        small = n_a * n_b <= SMALL_GROUP
        n = (n_a * n_b)[small]
        places = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        across = np.repeat(n_b[small], n)
        at_a = np.repeat(starts_a[small], n) + places // across
        at_b = np.repeat(starts_b[small], n) + places % across
        keys = np.sort(np.repeat(doc[small], n) * space + a[at_a] * self.width + b[at_b])
        firsts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else keys
        keys, times = keys[firsts], np.diff(np.r_[firsts, len(keys)])
        if not small.all():
            more, more_times = [keys], [times]
            for g in np.flatnonzero(~small).tolist():
                of_a, times_a = np.unique(a[starts_a[g] : starts_a[g] + n_a[g]], return_counts=True)
                of_b, times_b = np.unique(b[starts_b[g] : starts_b[g] + n_b[g]], return_counts=True)
                more.append((doc[g] * space + of_a[:, None] * self.width + of_b).ravel())
                more_times.append((times_a[:, None] * times_b).ravel())
            keys, times = np.concatenate(more), np.concatenate(more_times)
            order = np.argsort(keys, kind="stable")
            keys, times = keys[order], times[order]
            firsts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            keys, times = keys[firsts], np.add.reduceat(times, firsts)
        starts = np.searchsorted(keys, np.arange(n_docs + 1) * space)
        return starts, keys % space, times


@functools.lru_cache(maxsize=2)
def aligner(model_a: str, model_b: str) -> Aligner:
    """One per worker process and pair of files."""
    return Aligner(model_a, model_b)


_DOCUMENT = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_ALIGNED = f"row long, doc_id long, {_DOCUMENT}, pairs array<long>, times array<long>"


def aligned_documents(docs: DataFrame, model_a: str, model_b: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): its number, sizes, groups, distinct linked pairs and their times."""

    def build():
        found = aligner(model_a, model_b)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            *sizes, digests, (starts, pairs, times) = found.batch(batch.column(2).to_pylist())
            starts = pa.array(starts, pa.int32())
            columns = [
                batch.column(0),
                batch.column(1),
                *[pa.array(c, pa.int64()) for c in sizes],
                pa.array(digests, pa.string()),
                *[pa.ListArray.from_arrays(starts, pa.array(c, pa.int64())) for c in (pairs, times)],
            ]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _ALIGNED.split(", ")])

        return work

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
    )
    return map_batches(rows, build, _ALIGNED)


def pair_counts(found: DataFrame, width: int) -> DataFrame:
    """(pair, docs, best): documents that hold a linked pair, and if its first id has none in more."""
    counts = found.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    # A first id has at most ``width`` pairs.
    most = F.max("docs").over(Window.partitionBy(F.floor(F.col("pair") / width)))
    return counts.withColumn("best", F.col("docs") == most)


def _common(counts: DataFrame, bound: int) -> int:
    """The least number of documents that no more than ``bound`` pairs reach, among powers of two."""
    power = F.floor(F.log2("docs")).cast("int").alias("power")
    sizes = {r["power"]: r["n"] for r in counts.groupBy(power).agg(F.count("*").alias("n")).collect()}
    held = 0
    for p in sorted(sizes, reverse=True):
        held += sizes[p]
        if held > bound:
            return 1 << (p + 1)
    return 1


def alignment(docs: DataFrame, model_a: str, model_b: str, bound: int = BROADCAST_PAIRS) -> DataFrame:
    """Per row of ``docs``: tokens, groups, links, those with the most common partner, sum of counts."""
    width = len(prefix_table(model_b).pieces)
    found = stage(aligned_documents(docs, model_a, model_b), "aligned-documents")
    counts = stage(pair_counts(found, width), "pair-counts")
    least = _common(counts, bound)
    held = found.select("row", F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("times").alias("times"))))

    def summed(known: DataFrame) -> DataFrame:
        best: Column = F.when(F.col("best"), F.col("times")).otherwise(0)
        return known.groupBy("row").agg(
            F.sum(best).alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")
        )

    common = F.broadcast(counts.where(F.col("docs") >= least))
    sums = summed(held.join(common, "pair"))
    if least > 1:
        rest = held.join(common.select("pair"), "pair", "left_anti")
        sums = sums.unionByName(summed(rest.join(counts.where(F.col("docs") < least), "pair")))
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    names = [c.split()[0] for c in _DOCUMENT.split(", ")]
    return found.select("row", "doc_id", *names).join(sums, "row", "left").select(
        "doc_id",
        *names[:4],
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
