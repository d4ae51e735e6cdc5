"""Secret scans with multipart credential linking.

Three kinds are reported wherever they stand: assigned secrets, access identifiers and long hex
runs. Weaker parts (an account name, a mixed random string, an endpoint) say little alone. They
are reported only where complementary parts co-occur: an identifier and a secret within
``SCOPE`` characters of each other, in one block of text without an empty line; an endpoint, where
it lies within reach of such a pair. Parts are intervals in their document, joined by one sweep
over their sorted starts, so a document with many parts makes no pairs.

A document's parts meet in its own row: nothing is shuffled. Null text counts as empty and has
no spans; rows that share an id are scanned each by itself.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import map_batches

#: Characters between the ends of complementary parts.
SCOPE = 200
KINDS = ("assign", "access", "hex", "identity", "key", "endpoint")

# The base patterns and least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # a shorter run fails in any case
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
_WORDS = ("passw", "secret", "token", "api")

IDENTITY = re.compile(
    r"\b(?:ASIA|AROA|AIDA)[A-Z0-9]{12,}\b"
    r"|\b(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key_?id)"
    r"[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,}",
    re.IGNORECASE | re.ASCII,
)
KEY = re.compile(r"[A-Za-z0-9+/_-]{32,}={0,2}")
# A scheme and a host start where their run of characters does, so that no run is read once a character.
ENDPOINT = re.compile(
    r"(?<!\w)(?<![A-Za-z0-9][+.-])[a-z][a-z0-9+.-]*+://[^\s\"'<>]+"
    r"|\b\d{1,3}(?:\.\d{1,3}){3}(?::\d{2,5})?\b"
    r"|(?<![A-Za-z0-9-])(?<![A-Za-z0-9-]\.)(?:[A-Za-z0-9-]++\.)+(?:com|net|org|io|dev|internal|local)(?::\d{2,5})?\b",
    re.ASCII,
)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    out: list[Span] = []
    low = text.lower()
    if any(word in low for word in _WORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= ASSIGN_LEAST:
                out.append(("assign", *m.span()))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                out.append(("access", *m.span()))
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return out


def _mixed(word: str) -> bool:
    """Upper and lower case and digits: like a random string, unlike a word."""
    return any(map(str.isdigit, word)) and any(map(str.isupper, word)) and any(map(str.islower, word))


class _Intervals:
    """Disjoint or nested intervals in order of their starts."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted((a, b) for _, a, b in spans)
        self.starts = [a for a, _ in self.spans]
        self.ends: list[int] = []
        #: Of the furthest end so far: the first interval that has it.
        self.owners: list[int] = []
        for i, (_, b) in enumerate(self.spans):
            further = not self.ends or b > self.ends[-1]
            self.ends.append(b if further else self.ends[-1])
            self.owners.append(i if further else self.owners[-1])

    def overlap(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b)
        return i > 0 and self.ends[i - 1] > a

    def near(self, a: int, b: int, low: int, high: int) -> tuple[int, int] | None:
        """The nearest interval to [a, b), within SCOPE and within [low, high); ties: the earlier.

        Of those that start before ``a`` the furthest end is nearest, of the others the first start.
        No interval crosses ``low`` or ``high``, so either is the nearest of its block if it is in it.
        """
        i = bisect_left(self.starts, a)
        j = i
        while j < len(self.spans) and self.spans[j] == (a, b):
            j += 1
        found = ([self.spans[self.owners[i - 1]]] if i else []) + self.spans[j : j + 1]
        best = None
        for x, y in found:
            apart = max(x - b, a - y, 0)
            if apart <= SCOPE and low <= x and y <= high and (best is None or apart < best[0]):
                best = apart, (x, y)
        return best and best[1]


def _endpoints(text: str, reach: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Whole endpoints that meet an interval of ``reach``."""
    within = _Intervals([("", a, b) for a, b in reach])
    return [m.span() for m in ENDPOINT.finditer(text) if within.overlap(*m.span())] if reach else []


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak parts that complement others; ``base`` spans count as identifiers and secrets."""
    taken = _Intervals(base)
    ids = [("identity", *m.span()) for m in IDENTITY.finditer(text)] if ("=" in text or ":" in text or "A" in text) else []
    ids = [s for s in ids if not taken.overlap(s[1], s[2])]
    strong_ids = [s for s in base if s[0] == "access"]
    if not ids and not strong_ids:
        return []
    keys = [("key", *m.span()) for m in KEY.finditer(text) if _mixed(m.group())]
    named = _Intervals(ids)
    keys = [s for s in keys if not taken.overlap(s[1], s[2]) and not named.overlap(s[1], s[2])]
    secrets = _Intervals([s for s in base if s[0] != "access"] + keys)
    holders = _Intervals(ids + strong_ids)
    blocks = [m.end() for m in re.finditer(r"\n\s*\n", text)]

    def bounds(a: int) -> tuple[int, int]:
        i = bisect_right(blocks, a)
        return (blocks[i - 1] if i else 0), (blocks[i] if i < len(blocks) else len(text))

    out: list[Span] = []
    reach: list[tuple[int, int]] = []
    for part, others in ((ids + strong_ids, secrets), (keys, holders)):
        for span in part:
            low, high = bounds(span[1])
            other = others.near(span[1], span[2], low, high)
            if other:
                if span[0] != "access":
                    out.append(span)
                a, b = min(span[1], other[0]), max(span[2], other[1])
                reach.append((max(low, a - SCOPE), min(high, b + SCOPE)))
    found = {("endpoint", x, y) for x, y in _endpoints(text, reach)}
    used = _Intervals(base + out)
    return out + [s for s in sorted(found) if not used.overlap(s[1], s[2])]


def _joined(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in ordered)


_OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def credential_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): counts of the base kinds, their digest, all spans."""

    def build():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts, digests, spans = [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text)
                kinds = [s[0] for s in base]
                counts.append([kinds.count(k) for k in KINDS[:3]])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                spans.append(_joined(base + linked_spans(text, base)))
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, pa.array(digests), pa.array(spans)],
                [c.split()[0] for c in _OUT.split(", ")],
            )

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return map_batches(rows, build, _OUT)
