"""Whole-text encoding by a public tokenizer, with the pieces of a text looked up in a cache.

Both tokenizers cut a text at white space, and letters from other characters, before they merge
anything. So a text's ids are the ids of its pieces, one after another. Texts repeat their words:
a worker encodes each distinct piece once and joins the stored ids.
"""

from __future__ import annotations

import functools
import json
import re

import numpy as np

#: Pieces, and words, kept by a worker process, each of at most so many characters.
CACHE_LIMIT, CACHE_CHARS = 600_000, 48

_SPACED = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: White space other than blank and line feed: such texts are encoded as they are.
OTHER_SPACE = re.compile(
    "[\t\x0b\x0c\r\x1c-\x1f\x85\xa0 ᠎ -​    　﻿\x00]"
)
#: ASCII punctuation, that may follow a plain word.
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def plain(word: str) -> bool:
    """Latin-1 letters and nothing else: a single unit of both models."""
    return word.isalpha() and (word.isascii() or max(word) <= "\xff")


class Recent(dict):
    """Values by short keys, worked out when first asked for. Keys unused for long are left out, and
    long ones aren't kept, so the memory it takes is bounded.
    """

    def __init__(self, find, limit: int):
        self.find, self.half, self.older = find, limit // 2, {}

    def __missing__(self, key: str):
        value = self.older.get(key)
        if value is None:
            value = self.find(key)
            if len(key) > CACHE_CHARS:
                return value
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The printable character that byte-level models use for each byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in shown}
    table |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in table)}
    return [table[b] for b in range(256)]


class PieceEncoder:
    """Ids as little-endian unsigned 32-bit bytes; equal to the tokenizer's own."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = dict(enumerate(byte_letters()))
        made = json.loads(self.tokenizer.to_str())
        before, suffix = made["pre_tokenizer"] or {}, made["model"].get("end_of_word_suffix")
        #: "words": white space is dropped and case folded; "spaced": a blank goes with its word.
        self.kind = ""
        if suffix == "</w>" and before.get("type") == "Sequence":
            self.kind = "words"
        elif before.get("type") == "ByteLevel" and before["use_regex"] and not made["normalizer"]:
            self.kind = "spaced"
        #: Each id as it is written.
        self.written = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        #: Pieces, and pieces after a blank by their text without it. Plain words are pieces, too.
        self.cache = Recent(self.piece, CACHE_LIMIT)
        self.after_blank = Recent(self._after_blank, CACHE_LIMIT)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """One run of letters, with its blank if it has one: a single unit of the model."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.letters)
        elif word[0] == " ":
            word = self.letters[32] + word[1:]
        written = self.written
        return b"".join([written[t.id] for t in self.model.tokenize(word)])

    def piece(self, piece: str) -> bytes:
        """Of a plain word and marks after it, each is looked up or encoded by itself."""
        word = piece.rstrip(_MARKS)
        if plain(word):
            if len(word) < len(piece):
                return self.cache[word] + self.cache[piece[len(word) :]]
            if self.kind != "words":
                return self._word(word)
            folded = word.lower()
            return self._word(word) if folded == word else self.cache[folded]
        if self.kind != "words" and plain(word[1:]):
            if word[0] == " ":
                return self.after_blank[piece[1:]]
            if word[0] == "\n":
                return self.cache["\n"] + self.cache[piece[1:]]
        return self._whole(piece)

    def _after_blank(self, piece: str) -> bytes:
        word = piece.rstrip(_MARKS)
        if not plain(word):
            return self._whole(" " + piece)
        if len(word) < len(piece):
            return self.after_blank[word] + self.cache[piece[len(word) :]]
        return self._word(" " + word)

    def encode(self, text: str) -> bytes:
        if self.kind == "words":
            return b"".join(map(self.cache.__getitem__, text.replace("\n", " ").split(" ")))
        if self.kind != "spaced" or OTHER_SPACE.search(text):
            return self._whole(text)
        out, look = [], self.after_blank.__getitem__
        for i, line in enumerate(text.split("\n")):
            first, *rest = line.split(" ")
            if not first or "" in rest:  # runs of white space, or an end that is white space
                return b"".join(map(self.cache.__getitem__, _SPACED.findall(text)))
            out.append(self.cache["\n" + first if i else first])
            out.extend(map(look, rest))
        return b"".join(out)


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> PieceEncoder:
    """One per worker process and file."""
    return PieceEncoder(path)


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
