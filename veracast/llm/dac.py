"""Directly addressable codes: token ids split into chunk levels, any token readable by itself.

Level 0 holds the low eight bits of every id. A bitmap says which ids go on; those have their
next eight bits in level 1, and so forth. A rank directory (set bits before each block of the
bitmap) turns a place in one level into the place in the next, so reading token ``i`` takes one
step a level and no decoding of its neighbours.

Layout of a segment, little-endian: ``DAC1``, u32 number of ids, u32 number of levels; then per
level u32 length, chunks (u8), bitmap (bit i of byte i // 8), rank directory (u32 per block).
"""

from __future__ import annotations

import numpy as np

MAGIC = b"DAC1"
#: Bytes of bitmap that share an entry of the rank directory.
BLOCK = 32
_ONES = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)


def encode(ids: np.ndarray) -> bytes:
    """A segment of unsigned 32-bit ids; none gives a segment without levels."""
    rest = ids.astype(np.uint32)
    levels = []
    while len(rest):
        goes_on = rest > 255
        bitmap = np.packbits(goes_on, bitorder="little")
        ones = np.add.reduceat(_ONES[bitmap], np.arange(0, len(bitmap), BLOCK), dtype=np.uint32)
        before = (np.cumsum(ones) - ones).astype("<u4")
        size = np.array([len(rest)], "<u4").tobytes()
        chunks = (rest & 255).astype(np.uint8).tobytes()
        levels.append(size + chunks + bitmap.tobytes() + before.tobytes())
        rest = rest[goes_on] >> 8
    head = np.array([len(ids), len(levels)], "<u4").tobytes()
    return MAGIC + head + b"".join(levels)


class Segment:
    """Reads tokens of one segment by place; the bytes are viewed, not copied."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.n, n_levels = np.frombuffer(data, "<u4", 2, 4).tolist()
        self.levels, at = [], 12
        for _ in range(n_levels):
            size = int(np.frombuffer(data, "<u4", 1, at)[0])
            width = -(-size // 8)
            blocks = -(-width // BLOCK)
            chunks = np.frombuffer(data, np.uint8, size, at + 4)
            bitmap = np.frombuffer(data, np.uint8, width, at + 4 + size)
            ranks = np.frombuffer(data, "<u4", blocks, at + 4 + size + width)
            self.levels.append((chunks, bitmap, ranks))
            at += 4 + size + width + 4 * blocks

    def _rank(self, level: int, i: int) -> int:
        """Set bits before place ``i``."""
        _, bitmap, ranks = self.levels[level]
        byte = i // 8
        if byte == len(bitmap):  # the end of the level
            byte, i = byte - 1, i
            last = int(ranks[byte // BLOCK])
            return last + int(_ONES[bitmap[byte // BLOCK * BLOCK :]].sum())
        block = byte // BLOCK
        inside = int(_ONES[bitmap[block * BLOCK : byte]].sum())
        return int(ranks[block]) + inside + int(_ONES[bitmap[byte] & ((1 << i % 8) - 1)])

    def token(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * level
            if not bitmap[i // 8] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` to before ``end``; a range stays a range on every level."""
        if not 0 <= start <= end <= self.n:
            raise IndexError((start, end))
        out = np.zeros(end - start, dtype="<u4")
        places = np.arange(end - start)
        for level, (chunks, bitmap, _) in enumerate(self.levels):
            if start == end:
                break
            out[places] |= chunks[start:end].astype(np.uint32) << np.uint32(8 * level)
            bits = np.unpackbits(bitmap[start // 8 : -(-end // 8)], bitorder="little")
            goes_on = bits[start % 8 : start % 8 + end - start].astype(bool)
            places = places[goes_on]
            start = self._rank(level, start)
            end = start + len(places)
        return out
