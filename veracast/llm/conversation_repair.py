"""Conversation structure repair: the cheapest edits that give a conversation a legal order of roles.

A legal conversation is empty, or an optional system turn and then pairs of user and assistant
turns. Rows may be kept, given the other role, deleted, or preceded by inserted turns; each edit has
a cost, and among the cheapest sequences of edits the one that is least as ASCII text is taken.

* **Order.** Rows are dealt in ranges of (conversation, turn, role, text), so a conversation with a
  third of all rows lies in many tasks; their numbers in the staged ranges are the order from then
  on. Turns without a number come first; rows of one turn go by role, then by text.
* **Faults.** A duplicate is a row that isn't the first with its role and text: the first ones are
  smallest numbers, counted before the shuffle, and marked by a join on the unique number.
* **Edits.** A row's role and fault are one of 16 codes, a hexadecimal digit. A conversation's codes
  are one text, put together from bounded blocks, as long as the list of edits that is asked for.
  Cost vectors run backwards over it; only every ``sqrt(n)``-th is stored. The walk forward works
  out the vectors of one block again and takes the least edit that keeps the cost.
* **Text.** Rows and the edits of their block meet sorted by number, and repaired turns stream out.
  A SHA-256 of one conversation can't be split, so that pass reads a conversation in one task, a
  batch at a time; besides it only the edits of one block are held.

Null role or text counts as one blank, null conversation as one conversation, null turn as no
number. Rows that are equal in all columns are duplicates of one another. Other columns are ignored.
An empty table gives no rows; a conversation without rows has zeros, no edits and the empty digest.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import in_arrow, map_batches
from veracast.sources.scratch import stage

#: Numbered rows of a conversation that make one block.
BLOCK = 4_096
#: Rows with their texts that a task holds as Python strings at once.
_SLICE = 256
_LAST = (1 << 63) - 1
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

# Costs of the edits; a truncated row that stays costs more.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# A row's fault, and its role's initial: together the code 4 * initial + fault.
CLEAN, BLANK, DUPLICATE, CUT = range(4)
SYSTEM, USER, ASSISTANT, OTHER = range(4)
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}

# States: nothing yet, after a system turn, after a user turn, after an assistant turn.
_NEXT = (2, 2, 3, 2)  # a user turn, or an assistant turn after a user's
_ENDS = (0, 3)
_ROLES = {2: "user", 3: "assistant"}
_AFTER_KEPT = {"s": 1, "u": 2, "a": 3}
_NEVER = 1 << 60
Costs = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> Costs:
    for _ in range(3):
        costs = [min(c, INSERT + costs[_NEXT[q]]) for q, c in enumerate(costs)]
    return tuple(costs)


END: Costs = _with_inserts([0 if q in _ENDS else _NEVER for q in range(4)])


def _kept_state(state: int, initial: int) -> int | None:
    """The state after a row that keeps its role; none if the role can't follow."""
    if initial == SYSTEM:
        return 1 if state == 0 else None
    after = _NEXT[state]
    return after if (after, initial) in ((2, USER), (3, ASSISTANT)) else None


def _row_edits(state: int, code: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of a row's edits, in the order of their letters."""
    initial, fault = divmod(code, 4)
    edits = [("D", DELETE, state)]
    if fault in (CLEAN, CUT):
        more = TRUNCATED if fault == CUT else 0
        kept = _kept_state(state, initial)
        if kept is not None:
            edits.append(("K", KEEP + more, kept))
        edits.append(("R", REROLE + more, _NEXT[state]))
    return edits


_EDITS = [[_row_edits(state, code) for state in range(4)] for code in range(16)]


@functools.lru_cache(maxsize=65_536)
def _relative(code: int, after: Costs) -> Costs:
    return _with_inserts([min(cost + after[to] for _, cost, to in _EDITS[code][q]) for q in range(4)])


def costs_before(code: int, after: Costs) -> Costs:
    """Least costs from each state before a row, given those after it.

    Vectors differ from their least value by a bounded amount, so few differ otherwise.
    """
    least = min(after)
    found = _relative(code, tuple(c - least for c in after))
    return tuple(c + least for c in found)


def cheapest_edits(codes: list[int]) -> tuple[int, str, list[str]]:
    """Cost, edits, and the edits by row with those that precede it; one more for the end."""
    n = len(codes)
    step = max(1, math.isqrt(n))
    stored, costs = {}, END
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0 or i == n - 1:
            stored[i // step] = costs  # after the last row of the block
        costs = costs_before(codes[i], costs)
    total, state, by_row = costs[0], 0, []
    for block in range(math.ceil(n / step)):
        first, last = block * step, min(n, (block + 1) * step)
        after = [stored[block]]
        for i in range(last - 1, first, -1):
            after.append(costs_before(codes[i], after[-1]))
        after.reverse()
        for i, behind in zip(range(first, last), after):
            letters = ""
            here = costs_before(codes[i], behind)
            while True:
                tight = [
                    (letter, to)
                    for letter, cost, to in _EDITS[codes[i]][state]
                    if here[state] == cost + behind[to]
                ]
                if here[state] == INSERT + here[_NEXT[state]]:
                    tight.append(("I", _NEXT[state]))
                letter, state = min(tight)
                letters += letter
                if letter != "I":
                    break
            by_row.append(letters)
    letters = ""
    while END[state]:
        state, letters = _NEXT[state], letters + "I"
    by_row.append(letters)
    return total, "".join(by_row), by_row


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut off, repeated or made the user's, by a hash of conversation and turn."""
    blank = F.lit(" ")
    place = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    )
    kind, text = F.col("kind"), F.col("text")
    told = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
        F.pmod(F.crc32(place), F.lit(20)).alias("kind"),
    ).where("kind <> 0")
    times = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return told.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(times).alias("time"),
    ).drop("time")


def numbered(conversations: DataFrame) -> DataFrame:
    """Rows with ``pos``, a number that rises with conversation, turn, role and text; staged."""
    blank = F.lit(" ")
    rows = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
        # Tells equal rows apart, so that they too can lie in several ranges.
        F.monotonically_increasing_id().alias("place"),
    )
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "text"]
    ranged = rows.repartitionByRange(parts, *order, "place").sortWithinPartitions(*order)
    end = F.substring(F.rtrim("text", F.lit(_SPACE)), -1, 1)
    fault = F.when(end == "", BLANK).when(end.isin(".", "!", "?"), CLEAN).otherwise(CUT)
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT)
    return stage(
        ranged.drop("place").select(
            "*",
            F.monotonically_increasing_id().alias("pos"),
            initial.otherwise(OTHER).alias("initial"),
            fault.alias("fault"),
        ),
        "numbered-turns",
    )


def _codes(rows: DataFrame) -> DataFrame:
    """(conv_id, first, codes) of each block of a conversation, by its first number."""
    whole = rows.where(F.col("fault") != BLANK)
    firsts = whole.groupBy("conv_id", "role", F.sha2("text", 256)).agg(F.min("pos").alias("pos"))
    firsts = firsts.select("pos", F.lit(True).alias("is_first"))
    known = rows.select("conv_id", "pos", "initial", "fault").join(firsts, "pos", "left")
    again = (F.col("fault") != BLANK) & F.col("is_first").isNull()
    code = 4 * F.col("initial") + F.when(again, DUPLICATE).otherwise(F.col("fault"))
    digit = F.struct("pos", F.lower(F.hex(code)).alias("digit"))
    block = F.floor(F.col("pos") / BLOCK)
    blocks = known.groupBy("conv_id", block.alias("block")).agg(
        F.array_sort(F.collect_list(digit)).alias("rows")
    )
    return blocks.select(
        "conv_id",
        F.element_at("rows", 1).getField("pos").alias("first"),
        F.array_join("rows.digit", "").alias("codes"),
    )


_COUNTS = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_BLOCKS = "array<struct<pos: long, edits: string>>"


def edited(rows: DataFrame) -> DataFrame:
    """Per conversation of ``numbered`` rows: counts of faults, cost, all edits, and those of each block."""

    def of_one(parts: list[dict]) -> tuple:
        codes = [int(c, 16) for p in parts for c in p["codes"]]
        faults, initials = [c % 4 for c in codes], [c // 4 for c in codes]
        illegal = sum(pair not in _LEGAL for pair in zip(initials, initials[1:]))
        cost, audit, by_row = cheapest_edits(codes)
        blocks, at = [], 0
        for p in parts:
            to = at + len(p["codes"])
            blocks.append({"pos": p["first"], "edits": ",".join(by_row[at:to])})
            at = to
        if by_row[-1]:
            blocks.append({"pos": _LAST, "edits": by_row[-1]})
        return *map(faults.count, (BLANK, DUPLICATE, CUT)), illegal, cost, audit, blocks

    def build():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = zip(*map(of_one, batch.column(1).to_pylist()))
            block = pa.struct([("pos", pa.int64()), ("edits", pa.string())])
            kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(block)]
            columns = [pa.array(c, k) for c, k in zip(found, kinds)]
            names = ["conv_id", *(c.split()[0] for c in _COUNTS.split(", ")), "blocks"]
            return pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

        return work

    whole = _codes(rows).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("first", "codes"))).alias("blocks")
    )
    kind = dict(rows.dtypes)["conv_id"]
    return stage(map_batches(whole, build, f"conv_id {kind}, {_COUNTS}, blocks {_BLOCKS}"), "edits")


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of the turns after repair; a task has whole conversations in order."""
    of_blocks = edits.select("conv_id", F.inline("blocks")).select(
        "conv_id", "pos", F.lit(0).alias("what"), F.col("edits").alias("role"), F.lit("").alias("text")
    )
    of_rows = rows.select("conv_id", "pos", F.lit(1).alias("what"), "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state, place, pending = (), 0, 0, []
        for batch in batches:
            for first in range(0, batch.num_rows, _SLICE):
                part, out = batch.slice(first, _SLICE), []
                for i, (conv, pos, what, role, text) in enumerate(zip(*(c.to_pylist() for c in part.columns))):
                    if held != (conv,):
                        held, state, place = (conv,), 0, 0
                    if what == 0 and pos < _LAST:
                        pending = role.split(",")[::-1]
                        continue
                    for letter in pending.pop() if what else role:
                        if letter == "D":
                            continue
                        state = _AFTER_KEPT[role[0]] if letter == "K" else _NEXT[state]
                        shown = role if letter == "K" else _ROLES[state]
                        out.append((i, place, shown, "" if letter == "I" else text))
                        place += 1
                if out:
                    at, places, roles, texts = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0).take(pa.array(at)),
                            pa.array(places, pa.int64()),
                            pa.array(roles),
                            pa.array(texts),
                        ],
                        ["conv_id", "place", "role", "text"],
                    )

    met = of_blocks.unionByName(of_rows).repartition("conv_id")
    met = met.sortWithinPartitions("conv_id", "pos", "what")
    kind = dict(rows.dtypes)["conv_id"]
    return in_arrow(met, run, f"conv_id {kind}, place long, role string, text string")


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of conversations that lie whole and in order in their tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest, kind = None, None, None
        for batch in batches:
            kind, done = batch.schema.field(0).type, []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or conv != held:
                    if digest is not None:
                        done.append((held, digest.hexdigest()))
                    held, digest = conv, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    digest.update(f"\n{role}:{text}".encode())
            yield _found(done, kind)
        if digest is not None:
            yield _found([(held, digest.hexdigest())], kind)

    def _found(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        ids, texts = zip(*done) if done else ((), ())
        columns = [pa.array(ids, kind), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", "repaired_sha256"])

    kind = dict(turns.dtypes)["conv_id"]
    return in_arrow(turns.select("conv_id", "role", "text"), run, f"conv_id {kind}, repaired_sha256 string")


def repair_report(conversations: DataFrame, ids: DataFrame) -> DataFrame:
    """Per conversation of ``ids`` (conv_id): faults, cost, edits and the digest of its repaired turns.

    Conversations of ``ids`` without rows have zeros, no edits and the digest of an empty text.
    """
    rows = numbered(conversations)
    edits = edited(rows)
    turns = rows.groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    gaps = turns.groupBy("conv_id").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps")
    )
    found = ids.select("conv_id").distinct()
    for part in (gaps, edits.drop("blocks"), digests(repaired_turns(rows, edits))):
        found = found.unionByName(part, allowMissingColumns=True)
    counts = ["gaps", *(c.split()[0] for c in _COUNTS.split(", ")[:5])]
    empty = hashlib.sha256().hexdigest()
    return found.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(empty)).alias("repaired_sha256"),
    )
