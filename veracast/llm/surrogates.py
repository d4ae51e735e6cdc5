"""PII replaced by surrogates: keyed, of the same type and format, distinct and consistent.

E-mail addresses, phone numbers (international, and national ones in groups or after a leading 0),
card numbers, IBANs, social security numbers, IPv4 addresses and names after a title are found in
whole texts, and so is a name of two words wherever else it stands in a text that has it after a
title. A surrogate is a keyed function of the entity alone, so one entity has the same surrogate in
every document, and its spellings (case of an address, punctuation of a number) share it.

* Numbers and addresses: a keyed permutation of all strings of the same format. Letters stay letters,
  digits digits, octets octets; a valid card number or IBAN stays valid. Two entities never share one.
* Names: syllables of the same script, with the ending of the title's gender, as many words. A
  name is keyed by itself and not by its title: without a title, or after one that has no gender, it
  is the person of that name in the text, else in the corpus, if all of that name have one gender.
* Collision checks: a surrogate that another entity has too, or that is itself an entity of the
  corpus, is drawn again until no such surrogate is left. The checks run over the distinct
  entities; documents take part again only if they hold one that was redrawn. A format that is so
  full that ``MOST_ATTEMPTS`` draws don't do (a two-letter mail name) is permuted as a whole: all of
  it differ and none keeps its string, but a surrogate may then be another one's original.

Null text stays null; a text without entities stays as it is. Rows that share an id are rewritten
each by itself.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracast.llm.common import in_arrow, map_batches, row_key
from veracast.sources.scratch import stage

_EDGE, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
_NAME = r"[^\W\d_a-z][^\W\d_]+(?:-[^\W\d_]+)?"
# Titles by gender.
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Signora", "Г-жа", "Κυρία")
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Signor", "Г-н", "Κύριος")
NEUTRAL = ("Dr", "Prof")

#: Draws that avoid all others and all originals, and more for formats permuted as a whole.
MOST_ATTEMPTS, WHOLE_ATTEMPTS = 8, 64

PATTERNS = {
    # From the start of a run of its characters, so that no run is read once a character.
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[._%+-]*+(?P<email>[A-Za-z0-9][A-Za-z0-9._%+-]*+@"
        r"(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,})",
        re.ASCII,
    ),
    "iban": re.compile(
        rf"{_EDGE}[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?){_END}",
        re.ASCII,
    ),
    "ip": re.compile(
        rf"{_EDGE}(?<!\.)(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|1?\d?\d)"
        rf"(?!\.?[0-9]){_END}",
        re.ASCII,
    ),
    "card": re.compile(rf"{_EDGE}(?:\d{{13,19}}|\d{{4}}(?:[ -]\d{{4}}){{3}}){_END}", re.ASCII),
    "ssn": re.compile(rf"{_EDGE}(?<!-)\d{{3}}-\d{{2}}-\d{{4}}{_END}(?!-)", re.ASCII),
    "phone": re.compile(
        rf"{_EDGE}(?:\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?|\d{{1,4}}[ .-])?\d{{2,4}}"
        rf"(?:[ .-]?\d{{2,4}}){{1,3}}|\(\d{{3}}\) ?\d{{3}}-\d{{4}}|\d{{3}}[-.]\d{{3}}[-.]\d{{4}}"
        rf"|\d{{3}} \d{{3}} \d{{4}}|0\d{{1,4}}[ /-]\d{{5,8}})"
        rf"{_END}",
        re.ASCII,
    ),
    "name": re.compile(
        rf"(?<!\w)(?P<title>{'|'.join(FEMALE + MALE + NEUTRAL)})\.?[ ](?P<name>{_NAME}(?: {_NAME})?)"
    ),
}
_NEEDS = {"email": "@", "ip": ".", "ssn": "-"}
_BARE = re.compile(rf"(?<!\w)(?=({_NAME} {_NAME})(?!\w))")
# Syllables by script, and endings by gender.
SYLLABLES = {
    "LATIN": "ba be bi bo da de di do fa fe ga ge ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro".split(),
    "CYRILLIC": "ба бе би бо да де ди до га го ка ки ко ку ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са со".split(),
    "GREEK": "βα βε βι βο δα δε δι δο γα γο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σο".split(),
}
ENDINGS = {
    ("LATIN", "f"): "na", ("LATIN", "m"): "n", ("LATIN", ""): "r",
    ("CYRILLIC", "f"): "на", ("CYRILLIC", "m"): "н", ("CYRILLIC", ""): "р",
    ("GREEK", "f"): "να", ("GREEK", "m"): "ς", ("GREEK", ""): "ρ",
}

Entity = tuple[str, str]


class _Taken:
    """Places in a text that no two entities share."""

    def __init__(self):
        self.spans: list[tuple[int, int, str, str]] = []
        self.starts: list[int] = []

    def free(self, a: int, b: int) -> bool:
        i = bisect_right(self.starts, a)
        before = not i or self.spans[i - 1][1] <= a
        return before and (i == len(self.spans) or self.starts[i] >= b)

    def add(self, spans: list[tuple[int, int, str, str]]) -> None:
        """``spans`` that are free and don't overlap one another."""
        if spans:
            self.spans = sorted(self.spans + spans)
            self.starts = [a for a, *_ in self.spans]


def find_entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) in order, not overlapping; the earlier kind wins."""
    taken = _Taken()
    digits = bool(re.search(r"\d", text))
    for kind, pattern in PATTERNS.items():
        if (kind not in ("email", "name") and not digits) or _NEEDS.get(kind, "") not in text:
            continue
        found = []
        for m in pattern.finditer(text):
            a, b = m.span(kind) if kind in ("email", "name") else m.span()
            if taken.free(a, b) and (kind != "iban" or valid_iban(m[0])):
                found.append((a, b, kind, canonical(kind, m)))
        taken.add(found)
    genders = defaultdict(set)
    for *_, kind, entity in taken.spans:
        if kind == "name":
            gender, name = entity.split("|", 1)
            genders[name].add(gender)
    if not genders:
        return taken.spans
    if any(" " in name for name in genders):
        found, end = [], 0
        for m in _BARE.finditer(text):
            a, b = m.span(1)
            if m[1] in genders and a >= end and taken.free(a, b):
                found.append((a, b, "name", f"|{m[1]}"))
                end = b
        taken.add(found)

    def resolved(entity: str) -> str:
        known = genders[entity[1:]] - {""} if entity[0] == "|" else ()
        return min(known) + entity if len(known) == 1 else entity

    return [(a, b, k, resolved(e) if k == "name" else e) for a, b, k, e in taken.spans]


def valid_iban(text: str) -> bool:
    told = text.replace(" ", "")
    return 15 <= len(told) <= 34 and _iban_rest(told) == 1


def _iban_rest(told: str) -> int:
    return int("".join(str(int(c, 36)) for c in told[4:] + told[:4])) % 97


def canonical(kind: str, m: re.Match) -> str:
    if kind == "name":
        title = m["title"]
        gender = "f" if title in FEMALE else "m" if title in MALE else ""
        return f"{gender}|{m['name']}"
    if kind == "email":
        return m["email"].lower()
    if kind == "iban":
        return m[0].replace(" ", "").lower()
    return m[0] if kind == "ip" else re.sub(r"[^0-9+]", "", m[0])


def _draw(key: bytes, *parts: object) -> int:
    told = "\x00".join(map(str, parts)).encode("utf-8", "replace")
    return int.from_bytes(hashlib.blake2b(told, key=key, digest_size=8).digest(), "big")


def permuted(value: int, size: int, key: bytes, *tweak: object) -> int:
    """A keyed permutation of 0 .. ``size`` - 1: a Feistel network, walked until in range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    low = (1 << half) - 1
    while True:
        left, right = value >> half, value & low
        for i in range(8):
            mixed = 0
            for k in range(-(-half // 64)):
                mixed = mixed << 64 | _draw(key, *tweak, i, k, right)
            left, right = right, (left ^ mixed) & low
        value = left << half | right
        if value < size:
            return value


def _radix(c: str) -> tuple[str, int]:
    if "0" <= c <= "9":
        return "0", 10
    return ("a", 26) if "a" <= c <= "z" else ("", 1)


def _same_shape(text: str, key: bytes, *tweak: object) -> str:
    """Digits and letters a-z permuted among all texts with the same kinds in the same places."""
    kinds = [_radix(c) for c in text]
    size, value = 1, 0
    for c, (base, radix) in zip(text, kinds):
        if base:
            value, size = value * radix + ord(c) - ord(base), size * radix
    value = permuted(value, size, key, *tweak, "".join(b or c for c, (b, _) in zip(text, kinds)))
    out = list(text)
    for i in reversed(range(len(text))):
        base, radix = kinds[i]
        if base:
            value, rest = divmod(value, radix)
            out[i] = chr(ord(base) + rest)
    return "".join(out)


def _luhn(digits: str) -> int:
    """0 for a valid card number."""
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10


def _script(word: str) -> str:
    c = ord(word[0])
    return "CYRILLIC" if 0x400 <= c < 0x530 else "GREEK" if 0x370 <= c < 0x400 else "LATIN"


def surrogate(kind: str, entity: str, key: bytes, attempt: int = 0) -> str:
    """The canonical form of the replacement; ``attempt`` draws another."""
    if kind == "name":
        gender, name = entity.split("|", 1)
        words = []
        for i, word in enumerate(name.split(" ")):
            script, draw = _script(word), _draw(key, kind, name, attempt, i)
            made = "".join(SYLLABLES[script][draw >> 5 * k & 31] for k in range(3 + draw % 3))
            words.append((made + ENDINGS[script, gender]).capitalize())
        return f"{gender}|{' '.join(words)}"
    if kind == "ip":
        value = int.from_bytes(bytes(map(int, entity.split("."))), "big")
        made = permuted(value, 1 << 32, key, kind, attempt)
        return ".".join(map(str, made.to_bytes(4, "big")))
    if kind == "email":
        head, end = entity.rsplit(".", 1)
        return f"{_same_shape(head, key, kind, attempt)}.{end}"
    if kind == "iban":
        body = _same_shape(entity[4:], key, kind, entity[:2], attempt)
        return f"{entity[:2]}{98 - _iban_rest(entity[:2] + '00' + body):02d}{body}"
    if kind == "card" and not _luhn(entity):
        body = entity[0] + _same_shape(entity[1:-1], key, kind, entity[0], attempt)
        return body + str(-_luhn(body + "0") % 10)
    if kind == "card":
        made = entity
        while made == entity or not _luhn(made):  # the walk stays among invalid numbers
            made = made[0] + _same_shape(made[1:], key, kind, made[0], attempt)
        return made
    if kind == "phone" and entity.startswith("+"):
        return entity[:2] + _same_shape(entity[2:], key, kind, entity[:2], attempt)
    return _same_shape(entity, key, kind, attempt)


def domain(kind, entity: str) -> str:
    """Names the strings that the entity's surrogates are drawn from: one permutation moves them all."""

    def shape(text: str) -> str:
        return "".join(_radix(c)[0] or c for c in text)

    if kind == "email":
        head, end = entity.rsplit(".", 1)
        return f"{shape(head)}.{end}"
    if kind == "card":
        return f"{entity[0]}{len(entity)}{'' if _luhn(entity) else 'v'}"
    kept = {"iban": 2, "phone": 2 * entity.startswith("+")}.get(kind, 0)
    return entity[:kept] + shape(entity[kept:])


def _in_format(kind: str, shown: str, made: str) -> str:
    """The canonical ``made`` written as ``shown`` is."""
    if kind == "name":
        return made.split("|", 1)[1]
    if kind == "ip":
        return made
    if kind == "email":
        return "".join(c.upper() if s.isupper() else c for s, c in zip(shown, made))
    if kind == "iban":
        letters = iter(made.upper())
        return "".join(" " if c == " " else next(letters) for c in shown)
    digits = iter(made.lstrip("+"))
    return "".join(next(digits) if c.isdigit() else c for c in shown)


def _entities(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, key, kind, entity, made): the distinct entities of each row."""
    schema = "doc_id long, key long, kind string, entity string, made string"

    def build():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = [
                (doc_id, own, kind, entity, surrogate(kind, entity, key))
                for doc_id, own, text in zip(*(c.to_pylist() for c in batch.columns))
                for kind, entity in sorted({(k, e) for *_, k, e in find_entities(text)})
            ]
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
            names = ["doc_id", "key", "kind", "entity", "made"]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names
            )

        return work

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key(docs).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return map_batches(rows, build, schema)


def _redrawn(found: DataFrame, key: bytes) -> DataFrame | None:
    """(kind, entity, attempt) of the entities whose first surrogate collides; None if none does."""
    entities = stage(found.select("kind", "entity", "made").distinct(), "entities")
    originals = entities.select("kind", F.col("entity").alias("made")).distinct()

    def colliding(candidates: DataFrame, accepted: DataFrame | None) -> DataFrame:
        least = candidates.groupBy("kind", "made").agg(F.min("entity").alias("least"))
        taken = originals if accepted is None else originals.unionByName(
            accepted.select("kind", "made")
        )
        taken = taken.distinct().withColumn("taken", F.lit(True))
        judged = candidates.join(least, ["kind", "made"]).join(taken, ["kind", "made"], "left")
        return judged.where((F.col("entity") != F.col("least")) | F.col("taken")).select(
            "kind", "entity", "made"
        )

    def again(rows: DataFrame, attempt: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pairs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
                made = pa.array([surrogate(k, e, key, attempt) for k, e in pairs], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, made], ["kind", "entity", "made"]
                )

        return in_arrow(rows.select("kind", "entity"), run, "kind string, entity string, made string")

    bad, attempt, settled = stage(colliding(entities, None), "entities-colliding"), 0, None
    if bad.isEmpty():
        return None
    accepted = entities.join(bad.select("kind", "entity"), ["kind", "entity"], "left_anti")
    while attempt < MOST_ATTEMPTS and not bad.isEmpty():
        attempt += 1
        drawn = stage(again(bad, attempt), "entities-redrawn")
        bad = stage(colliding(drawn, accepted), "entities-colliding")
        good = drawn.join(bad.select("kind", "entity"), ["kind", "entity"], "left_anti")
        accepted = accepted.unionByName(good)
        good = good.select("kind", "entity", F.lit(attempt).alias("attempt"))
        settled = good if settled is None else settled.unionByName(good)
    if bad.isEmpty():
        return settled
    # Formats without room: all their entities by one permutation, one that leaves none in place.
    left = stage(_of_domains(entities, bad), "entities-of-full-formats")
    settled = settled.join(left.select("kind", "entity"), ["kind", "entity"], "left_anti")
    while attempt < MOST_ATTEMPTS + WHOLE_ATTEMPTS and not left.isEmpty():
        attempt += 1
        drawn = again(left, attempt).join(left, ["kind", "entity"])
        stuck = drawn.where("made = entity").select("kind", "domain").distinct()
        drawn = stage(drawn.join(stuck.withColumn("stuck", F.lit(True)), ["kind", "domain"], "left"), "entities-permuted")
        good = drawn.where(F.col("stuck").isNull() | (attempt == MOST_ATTEMPTS + WHOLE_ATTEMPTS))
        settled = settled.unionByName(good.select("kind", "entity", F.lit(attempt).alias("attempt")))
        left = drawn.where("stuck").select("kind", "entity", "domain")
    return settled


def _of_domains(entities: DataFrame, bad: DataFrame) -> DataFrame:
    """(kind, entity, domain) of all entities whose format has one of ``bad``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            named = pa.array([domain(k, e) for k, e in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, named], ["kind", "entity", "domain"])

    named = in_arrow(entities.select("kind", "entity"), run, "kind string, entity string, domain string")
    full = named.join(bad.select("kind", "entity"), ["kind", "entity"], "left_semi")
    return named.join(full.select("kind", "domain").distinct(), ["kind", "domain"], "left_semi").select(
        "kind", "entity", "domain"
    )


def _persons(found: DataFrame) -> DataFrame:
    """(entity, shown_as): names without a gender of which the corpus knows one gender only."""
    told = found.where("kind = 'name'").select("entity").distinct()
    gender = F.substring_index("entity", "|", 1)
    known = F.when(gender != "", gender)
    name = F.expr("substring(entity, instr(entity, '|') + 1)")
    by_name = told.groupBy(name.alias("name")).agg(
        F.min(known).alias("low"), F.max(known).alias("high"), F.bool_or(gender == "").alias("open")
    )
    return by_name.where("open AND low = high").select(
        F.concat(F.lit("|"), "name").alias("entity"), F.concat("low", F.lit("|"), "name").alias("shown_as")
    )


def replace_entities(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_entities): every row of ``docs`` with surrogates for its entities."""
    found = stage(_entities(docs, key), "document-entities")
    redrawn = _redrawn(found, key)
    persons = stage(_persons(found), "persons").withColumn("kind", F.lit("name"))
    same = persons.select("kind", "entity", "shown_as", F.lit(0).alias("attempt"))
    if redrawn is not None:
        drawn = redrawn.withColumnRenamed("entity", "shown_as")
        same = same.drop("attempt").join(drawn, ["kind", "shown_as"], "left")
        same = same.select("kind", "entity", "shown_as", F.coalesce("attempt", F.lit(0)).alias("attempt"))
        others = redrawn.join(persons.select("kind", "entity"), ["kind", "entity"], "left_anti")
        same = same.unionByName(others.withColumn("shown_as", F.col("entity")))
    per_row = (
        found.join(same, ["kind", "entity"])
        .groupBy("doc_id", "key")
        .agg(F.collect_list(F.struct("kind", "entity", "shown_as", "attempt")).alias("redrawn"))
        .withColumnsRenamed({"doc_id": "i", "key": "k"})
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = rows.withColumn("key", row_key(rows)).join(
        per_row, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("k")), "left"
    )

    def build():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts, counts = [], []
            for text, others in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                drawn = {(o["kind"], o["entity"]): (o["shown_as"], o["attempt"]) for o in others or ()}
                spans = find_entities(text) if text is not None else []
                out, at = [], 0
                for a, b, kind, entity in spans:
                    entity, attempt = drawn.get((kind, entity), (entity, 0))
                    made = surrogate(kind, entity, key, attempt)
                    out += [text[at:a], _in_format(kind, text[a:b], made)]
                    at = b
                texts.append("".join([*out, text[at:]]) if spans else text)
                counts.append(len(spans))
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int64())],
                ["doc_id", "text", "n_entities"],
            )

        return work

    return map_batches(
        rows.select("doc_id", "text", "redrawn"), build, "doc_id long, text string, n_entities long"
    )
