"""SentencePiece encoding by a table of prefixes, and decoding by the library.

A merge-type model joins, again and again, the two neighbours whose piece has the best score, the
leftmost ones on a tie. Joins that stay inside a part of the text don't depend on the rest of it. So:

* every prefix of a text has one encoding, and a text's tokens up to any of their ends are the
  encoding of that prefix. The table stores, for each prefix, its last token alone;
* tokens in a row are an encoding if and only if each two neighbours are the encoding of their
  joined text (``Merges.compatible``). An automaton over all pieces names those that end at a
  place; the one that is compatible with the last token of the prefix before it is the last one;
* the ids are read backwards: from the end to where the last token starts, and so on.

That takes time in proportion to the text, whatever its length, and a list of one number a
character. No piece holds a blank after another character, nor most marks after a letter, so a text
falls apart there (``cuts``); each worker keeps the ids of short parts that it met lately, up to
``CACHE_LIMIT``.

Null text counts as empty and has no ids. Rows that share an id are encoded each by itself; other
columns don't matter. An empty table gives no rows.
"""

from __future__ import annotations

import functools
import hashlib
import re
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import map_batches
from veracast.llm.tokens import Recent

#: Parts of texts whose ids a worker keeps: about 150 MB.
CACHE_LIMIT = 300_000
#: Pairs of tokens whose compatibility a worker keeps.
PAIR_LIMIT = 400_000
BLANK = "▁"
_LETTERS = "A-Za-z0-9À-ÖØ-öø-ɏ"


class Merges:
    """Pieces that merges can make, with their scores, and how each one comes together."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.histories: dict[str, list[tuple[float, str, str]] | None] = {}

    def joined(self, text: str) -> tuple[list[str], list[tuple[float, str, str]]]:
        """The parts that remain, and each merge's score with the first and last part after it."""
        parts, history = list(text), []
        while True:
            best, at = None, -1
            for i, pair in enumerate(zip(parts, parts[1:])):
                score = self.scores.get(pair[0] + pair[1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts, history
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            history.append((best, parts[0], parts[-1]))

    def history(self, piece: str) -> list[tuple[float, str, str]] | None:
        """A piece's merges in their order; None for one that merges don't make."""
        if piece not in self.histories:
            parts, history = self.joined(piece)
            self.histories[piece] = history if parts == [piece] else None
        return self.histories[piece]

    def compatible(self, left: str, right: str) -> bool:
        """Whether no merge crosses from one into the other while both come together."""
        before, after = self.history(left), self.history(right)
        i = j = 0
        edge, start = left[-1], right[0]
        while True:
            first = before[i][0] if i < len(before) else None
            second = after[j][0] if j < len(after) else None
            across = self.scores.get(edge + start)
            if across is not None and (first is None or across > first):
                if second is None or across >= second:
                    return False
            if first is None and second is None:
                return True
            if second is None or (first is not None and first >= second):
                edge = before[i][2]
                i += 1
            else:
                start = after[j][1]
                j += 1


def cuts(pieces: set[str]) -> re.Pattern[str]:
    """Parts of a text that no piece crosses: from blank to blank, and words apart from marks after them.

    Marks are what follows a letter or digit in no piece. A line feed is a part if no piece has one.
    """
    pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
    if any(y == BLANK != x for x, y in pairs):
        raise ValueError("pieces with a blank after another character aren't supported")
    letter = re.compile(f"[{_LETTERS}]")
    after = {y for x, y in pairs if letter.match(x)}
    marks = "".join(re.escape(c) for c in map(chr, range(128)) if not c.isalnum() and c not in after)
    feed = "" if any("\n" in p for p in pieces) else "\n"
    parts = [f"{BLANK}*[{_LETTERS}]+(?=[{marks}{BLANK}]|\\Z)", f"{BLANK}*[^{BLANK}{feed}]+"]
    return re.compile("|".join([*parts, *feed, f"{BLANK}+"]))


class PrefixTable:
    """Ids of whole texts, equal to the library's own."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.library.get_piece_size())
        special = (
            self.library.is_control,
            self.library.is_unknown,
            self.library.is_byte,
            self.library.is_unused,
        )
        self.pieces = [self.library.id_to_piece(i) for i in ids]
        usable = [i for i in ids if not any(kind(i) for kind in special)]
        self.merges = Merges({self.pieces[i]: self.library.get_score(i) for i in usable})
        self.automaton = ahocorasick.Automaton()
        letters = set()
        for i in usable:
            if self.merges.history(self.pieces[i]) is not None:
                self.automaton.add_word(self.pieces[i], (len(self.pieces[i]), i))
                letters.update(self.pieces[i])
        self.automaton.make_automaton()
        if not letters <= set(self.merges.scores):
            raise ValueError("pieces with a character that is no piece aren't supported")
        self.bytes = [self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.pairs: dict[int, bool] = {}
        self.cuts = cuts(set(self.merges.scores))
        self.parts = Recent(self.part, CACHE_LIMIT)

    def _fits(self, left: int, right: int) -> bool:
        pair = left * len(self.pieces) + right
        found = self.pairs.get(pair)
        if found is None:
            if len(self.pairs) >= PAIR_LIMIT:
                self.pairs.clear()
            found = self.merges.compatible(self.pieces[left], self.pieces[right])
            self.pairs[pair] = found
        return found

    def last_tokens(self, text: str) -> list[int]:
        """The last token of each prefix; -1 after a letter that no piece holds."""
        last = [-1] * (len(text) + 1)
        known, n = self.pairs, len(self.pieces)
        filled = -1
        for end, (length, token) in self.automaton.iter(text):
            if end == filled:
                continue
            before = last[end + 1 - length]
            if before >= 0:
                fits = known.get(before * n + token)
                if fits is None:
                    fits = self._fits(before, token)
                if not fits:
                    continue
            last[end + 1], filled = token, end
        return last

    def part(self, text: str) -> tuple[int, ...]:
        last, out, end = self.last_tokens(text), [], len(text)
        while end:
            token = last[end]
            if token >= 0:
                out.append(token)
                end -= len(self.pieces[token])
            else:
                end -= 1
                out += [self.bytes[b] for b in reversed(text[end].encode())]
        out.reverse()
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        whole = BLANK + text.replace(" ", BLANK)
        return list(chain.from_iterable(map(self.parts.__getitem__, self.cuts.findall(whole))))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@functools.lru_cache(maxsize=2)
def prefix_table(path: str) -> PrefixTable:
    """One per worker process and file."""
    return PrefixTable(path)


_OUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encoded_and_decoded(docs: DataFrame, model: str) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): how many ids, their digest, and that of their decoded text."""

    def build():
        table = prefix_table(model)
        shown = [str(i) for i in range(len(table.pieces))]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, ids_digests, text_digests = [], [], []
            for text in batch.column(1).to_pylist():
                ids = table.encode(text)
                sizes.append(len(ids))
                listed = ",".join(map(shown.__getitem__, ids))
                ids_digests.append(hashlib.sha256(listed.encode()).hexdigest())
                text_digests.append(hashlib.sha256(table.decode(ids).encode()).hexdigest())
            columns = [pa.array(sizes, pa.int64()), pa.array(ids_digests), pa.array(text_digests)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *columns], [c.split()[0] for c in _OUT.split(", ")]
            )

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return map_batches(rows, build, _OUT)
