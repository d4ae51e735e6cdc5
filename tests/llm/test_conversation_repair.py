"""Conversation repair against all edit sequences and a plain version of the whole query."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veracast.llm import conversation_repair as repair
from veracast.llm import queries

LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(codes):
    """(cost, edits) by trying edits in order of (cost, text); roles are checked at the end."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, edits, i, roles = heapq.heappop(heap)
        if i == len(codes) and LEGAL.fullmatch(roles):
            return cost, edits
        # What follows depends on the roles only through their last one.
        state = i, roles[-1:]
        if state in seen and (state, cost, edits) not in seen:
            continue
        seen.update([state, (state, cost, edits)])
        for role in "ua":
            if LEGAL.fullmatch(roles + role) or LEGAL.fullmatch(roles + role + "a"):
                heapq.heappush(heap, (cost + 5, edits + "I", i, roles + role))
        if i == len(codes):
            continue
        initial, fault = "sua?"[codes[i] // 4], codes[i] % 4
        heapq.heappush(heap, (cost + 2, edits + "D", i + 1, roles))
        if fault in (0, 3):
            more = 5 * (fault == 3)
            for role, letter, price in [(initial, "K", 0), ("u", "R", 1), ("a", "R", 1)]:
                then = roles + role
                if any(LEGAL.fullmatch(then + end) for end in ("", "a", "ua")):
                    heapq.heappush(heap, (cost + price + more, edits + letter, i + 1, then))


@given(st.lists(st.integers(0, 15), max_size=9))
@settings(max_examples=400, deadline=None)
def test_cheapest_edits(codes):
    cost, edits, by_row = repair.cheapest_edits(codes)
    assert (cost, edits) == cheapest(codes)
    assert "".join(by_row) == edits and len(by_row) == len(codes) + 1
    assert all(e.lstrip("I") in set("DKR") for e in by_row[:-1])


def test_checkpoints_of_a_long_conversation(monkeypatch):
    codes = [(i * i + i // 7) % 16 for i in range(5_000)]
    cost, edits, _ = repair.cheapest_edits(codes)
    monkeypatch.setattr(repair.math, "isqrt", lambda n: n)  # every vector stays
    assert repair.cheapest_edits(codes)[:2] == (cost, edits)


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        place = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(place.encode()) % 20
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        for _ in range((kind != 0) + (kind == 3)):
            yield conv, turn, role, text


def plain_report(rows, conversations):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        held[conv].append((turn is not None, turn or 0, role.encode(), text.encode(), role, text))
    out = {}
    for conv in conversations:
        turns = sorted(held[conv])
        counts, seen, codes = Counter(), set(), []
        for *_, role, text in turns:
            body = text.rstrip("\x20\x09\x0a\x0b\x0c\x0d")
            if not body:
                fault = 1
            elif (role, text) in seen:
                fault = 2
            else:
                fault = 0 if body[-1] in ".!?" else 3
            seen.add((role, text))
            counts[fault] += 1
            codes.append(4 * max("sua".find(role[:1]) if role else 3, -1) % 16 + fault)
        codes = [c if c >= 0 else 12 + c % 4 for c in codes]
        pairs = zip(turns, turns[1:])
        illegal = sum(a[4][:1] + b[4][:1] not in ("su", "ua", "au") for a, b in pairs)
        numbers = {t[1] for t in turns if t[0]}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        cost, audit = cheapest(codes)
        lines, rest, last = [], iter(turns), ""
        for letter in audit:
            *_, role, text = next(rest) if letter != "I" else ("", "")
            if letter in "RI":
                role = "assistant" if last == "u" else "user"
            if letter != "D":
                last = role[0]
                lines.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, counts[1], counts[2], counts[3], illegal, cost, audit, digest)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _found(df):
    rows = df.collect()
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(found) == len(rows)
    return found


def test_given_conversations(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    want = plain_report(plain_damage(rows), {r[0] for r in rows})
    assert _found(queries.op12_checkpointed_repair(spark, sf_dir)) == want


KIND = "conv_id long, turn long, role string, text string"


def test_odd_conversations(spark, write_tables, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK", 8)
    rows = [
        (1, None, "user", "No number."),
        (1, None, None, None),
        (1, 0, "user", "Tied b."),
        (1, 0, "user", "Tied a."),
        (1, 0, "system", "Tied s!"),
        (2, 5, "", "No role."),
        (2, 6, "tool", "Other role?"),
        (2, 7, "Assistant", "A capital"),
        (3, 1, "assistant", " \t\n\x0b\x0c\r"),
        (3, 1, "assistant", " \t\n\x0b\x0c\r"),
        (None, 1, "user", "No conversation."),
        (None, None, None, ""),
        (4, -3, "user", "ß "),
        (4, 9, "assistant", "word. " * 50_000),
    ]
    rows += [(7, i, ("user", "assistant")[i * i % 3 % 2], f"Turn {i % 50}.") for i in range(400)]
    rows += [(8, 3, "user", "Same.")] * 60
    # A conversation that the damage drops whole.
    dropped = next(i for i in range(100, 1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((dropped, 0, "user", "Gone."))
    made = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], f"{KIND}, blank string, pos int, blocks int")
    folder = write_tables(conversations=made.repartition(5))
    want = plain_report(plain_damage(rows), {r[0] for r in rows})
    found = _found(queries.op12_checkpointed_repair(spark, folder))
    assert found == want
    empty = hashlib.sha256().hexdigest()
    assert found[dropped] == (0, 0, 0, 0, 0, 0, "", empty)


def test_turns_come_out_repaired(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Well?"), (2, 0, "assistant", "x")]
    placed = repair.numbered(spark.createDataFrame(rows, KIND))
    turns = repair.repaired_turns(placed, repair.edited(placed)).collect()
    assert [tuple(t) for t in turns] == [(1, 0, "user", "Hi."), (1, 1, "assistant", "Well?")]


@pytest.mark.parametrize("kind", [KIND, "conv_id string, turn int, role string, text string"])
def test_no_conversations(spark, write_tables, kind):
    folder = write_tables(conversations=spark.createDataFrame([], kind))
    assert queries.op12_checkpointed_repair(spark, folder).collect() == []
