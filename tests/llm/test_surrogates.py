"""Surrogates: no entity left, same format, distinct, consistent, redrawn where they collide."""

from __future__ import annotations

import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from veracast.llm import surrogates
from veracast.llm.surrogates import find_entities, permuted, replace_entities, surrogate

KEY = b"a key for tests"
TEXT = (
    "Write to Jane.Doe7@Mail.example.com or jane.doe7@mail.example.com, call +1 (564) 555-4526 or "
    "+1-564-555-4526, from 152.143.123.131; card 4785 3805 9239 1139, again 4785380592391139$$$, "
    "ssn 078-05-1120. Mrs Maria Stone met Herr Karl Gruß and Dr. Иванов. Г-жа Ольга Петрова too."
)


def _kinds(text):
    return [k for *_, k, _ in find_entities(text)]


def test_every_kind_is_found():
    kinds = _kinds(TEXT)
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "email": 2, "phone": 2, "ip": 1, "card": 2, "ssn": 1, "name": 4
    }


def test_no_entities_in_plain_text():
    for text in ("", "In 2021 we had 3.14 and 1.2.3.4.5 or 2021-03-04", "deadbeef0123456789abcdef01234567"):
        assert find_entities(text) == []


def test_replacement(messy):
    rows = [(1, TEXT), (2, "only jane.doe7@mail.example.com"), (3, None), (4, "")]
    got = {r.doc_id: r for r in replace_entities(messy(rows), KEY).collect()}
    text = got[1].text
    assert got[1].n_entities == 12 and got[3].text is None and got[4].text == ""
    assert _kinds(text) == _kinds(TEXT)
    for _, _, kind, entity in find_entities(TEXT):
        assert entity.split("|")[-1] not in text
    mails = re.findall(r"\S+@[\w.]+\w", text)
    assert mails[0].lower() == mails[1] and mails[0] != mails[1] and mails[1] in got[2].text
    phones = [re.sub(r"\D", "", text[a:b]) for a, b, k, _ in find_entities(text) if k == "phone"]
    assert phones[0] == phones[1]
    cards = [re.sub(r"\D", "", text[a:b]) for a, b, k, _ in find_entities(text) if k == "card"]
    assert cards[0] == cards[1] and "4785380592391139" not in cards
    shape = re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", TEXT.split(" or ")[0])))
    assert re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "0", text.split(" or ")[0]))) == shape


def test_names_match_gender_and_script():
    for entity, end in (("f|Maria Stone", "na"), ("m|Karl Gruß", "n"), ("f|Ольга Петрова", "на")):
        made = surrogate("name", entity, KEY)
        assert made[:2] == entity[:2] and made.endswith(end)
        assert len(made.split(" ")) == len(entity.split(" "))


def test_valid_cards_stay_valid():
    for card, valid in (("4111111111111111", True), ("4111111111111112", False)):
        made = surrogate("card", card, KEY)
        assert made != card and (surrogates._luhn(made) == 0) is valid and made[0] == "4"


@pytest.mark.parametrize("size", [1, 2, 10, 1000])
def test_permutation(size):
    assert sorted(permuted(i, size, KEY, "t") for i in range(size)) == list(range(size))
    if size == 1000:
        assert [permuted(i, size, b"another", "t") for i in range(9)] != [
            permuted(i, size, KEY, "t") for i in range(9)
        ]


@given(st.sets(st.from_regex(r"[a-z]{1,2}[0-9]?@[a-z]{1,2}\.com", fullmatch=True), max_size=30))
@settings(max_examples=50, deadline=None)
def test_distinct(mails):
    assert len({surrogate("email", m, KEY) for m in mails}) == len(mails)


def test_collisions_are_redrawn(messy, monkeypatch):
    """With a first draw that gives everyone the same name, or another's, all still differ."""
    plain = surrogates.surrogate

    def poor(kind, entity, key, attempt=0):
        if kind == "name" and attempt == 0:
            return "f|Anna Bell" if "Stone" in entity else "f|Same Name"
        return plain(kind, entity, key, attempt)

    monkeypatch.setattr(surrogates, "surrogate", poor)
    names = ["Anna Bell", "Maria Stone", "Eva Long", "Ida Short", "Una Wide"]
    rows = [(i, f"Mrs {n} and Mrs {names[0]} met.") for i, n in enumerate(names)]
    found = surrogates.stage(surrogates._entities(messy(rows), KEY), "entities-test")
    redrawn = surrogates._redrawn(found, KEY)
    again = {r.entity for r in redrawn.collect()}
    assert "f|Maria Stone" in again and len(again) >= 3
    got = {r.doc_id: r.text for r in replace_entities(messy(rows), KEY).collect()}
    first = {i: re.findall(r"Mrs (\w+ \w+)", t) for i, t in got.items()}
    assert len({v[0] for v in first.values()}) == 5
    assert {v[1] for v in first.values()} == {first[0][0]}
    assert not {v[0] for v in first.values()} & set(names)


def test_odd_rows(messy, odd_rows):
    found = replace_entities(messy(odd_rows), KEY).collect()
    assert sorted(((r.doc_id, r.text) for r in found), key=str) == sorted(odd_rows, key=str)
    assert replace_entities(messy([]), KEY).collect() == []


def test_national_phones_and_ibans():
    text = "Call 415 555 0123 or 030 1234567; pay DE89 3704 0044 0532 0130 00 or GB82WEST12345698765432."
    assert _kinds(text) == ["phone", "phone", "iban", "iban"]
    assert "iban" not in _kinds("pay DE88 3704 0044 0532 0130 00 now")
    made = surrogate("iban", "gb82west12345698765432", KEY)
    assert surrogates.valid_iban(made.upper()) and made[:2] == "gb" and made[4:8].isalpha()


def test_one_person_whatever_the_title(messy):
    rows = [
        (1, "Anna Meyer wrote. Mrs. Anna Meyer met Dr. Anna Meyer; Anna Meyer left."),
        (2, "Prof. Anna Meyer spoke."),
        (3, "Mr Kim Lee and Mrs Kim Lee and Dr Kim Lee."),
        (4, "Anna Meyer without a title is nobody."),
    ]
    got = {r.doc_id: r for r in replace_entities(messy(rows), KEY).collect()}
    assert [got[i].n_entities for i in range(1, 5)] == [4, 1, 3, 0]
    her = set(re.findall(r"\w+na \w+na", got[1].text))
    assert len(her) == 1 and got[1].text.count(min(her)) == 4 and min(her) in got[2].text
    assert len(set(re.findall(r"M?r?s? ?(\w+ \w+)(?= and|\.)", got[3].text))) == 3
    assert got[4].text == rows[3][1]


def test_full_formats_are_permuted_as_a_whole(messy):
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.co" for a in letters for b in letters]
    rows = [(i, " ".join(mails[i::5])) for i in range(5)] + [(9, "q@x.org")]
    got = {r.doc_id: r.text.split() for r in replace_entities(messy(rows), KEY).collect()}
    made = [m for i in range(5) for m in got[i]]
    assert sorted(made) == mails
    assert all(m != own for i in range(5) for m, own in zip(got[i], mails[i::5]))


@pytest.mark.parametrize("text", [" ".join(f"u{i}@mail.example.com" for i in range(8_000)), "x@y.co " + "a" * 1_000_000, "a." * 400_000 + " x@y.co", "@".join("a" * 300_000) + " x@y.co"])
def test_long_texts_in_linear_time(text):
    start = time.perf_counter()
    assert find_entities(text)
    assert time.perf_counter() - start < 3


@given(st.lists(st.tuples(st.integers(0, 60), st.integers(1, 6)), max_size=20))
@settings(max_examples=200, deadline=None)
def test_taken_places(spans):
    taken, held = surrogates._Taken(), []
    for a, n in spans:
        free = all(a + n <= x or y <= a for x, y in held)
        assert taken.free(a, a + n) is free
        if free:
            taken.add([(a, a + n, "k", "e")])
            held.append((a, a + n))
