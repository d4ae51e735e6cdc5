"""Contamination against a plain reading of the rules; native plans."""

from __future__ import annotations

import random
import re

import pytest

from veracast.llm import decontamination

ITEMS = "item_id long, text string"


def _words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def plain(docs, items):
    windows = set()
    for item_id, text in items:
        w = _words(text)
        for s in range(max(len(w) - 9, 1) if w else 0):
            windows.add((item_id, tuple(w[s : s + 10])))
    out = []
    for doc_id, text in docs:
        w = _words(text)
        hit, found = set(), set()
        for item_id, win in windows:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit.update(range(s, s + len(win)))
                    found.add(item_id)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), ids))
    return sorted(out, key=str)


def found(spark, messy, docs, items):
    rows = decontamination.contamination(messy(docs), spark.createDataFrame(items, ITEMS)).collect()
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, r.item_ids) for r in rows), key=str)


def _cases(seed):
    draw = random.Random(seed)
    vocabulary = ["the", "of", "Été", "été", "x1", "WORD", "word", "z", "β"]
    items = [
        (i, " ".join(draw.choice(vocabulary) for _ in range(draw.choice([0, 1, 2, 3, 4, 6, 9, 10, 11, 25]))))
        for i in range(14)
    ]
    items += [(3, items[3][1]), (None, items[9][1]), (20, None), (21, "...")]
    docs = []
    for i in range(40):
        parts = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 12))) for _ in range(3)]
        if i % 2:
            parts.insert(1, draw.choice(items)[1] or "")
        docs.append((i, draw.choice([" ", ", ", "\n"]).join(parts)))
    return docs, items


@pytest.mark.parametrize("limit", [2_000_000, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_random_texts(spark, messy, odd_rows, seed, limit, monkeypatch):
    monkeypatch.setattr(decontamination, "BROADCAST_SHINGLES", limit)
    docs, items = _cases(seed)
    docs = docs + [r for r in odd_rows if r[0] != 5] + docs[1:2]
    assert found(spark, messy, docs, items) == plain(docs, items)


def test_window_boundaries(spark, messy):
    item = [(1, " ".join(f"w{i}" for i in range(12)))]
    body = item[0][1].split()
    docs = [
        (1, " ".join(body[:10])),  # exactly one window, all of the text
        (2, " ".join(body[:9])),
        (3, " ".join(["a", *body[2:12], "b"])),
        (4, " ".join([*body[:5], "other", *body[5:]])),
        (5, " ".join(body + body)),
        (6, " ".join(w.upper() for w in body)),
        (7, " ".join(w.replace("w", "É") for w in body)),
    ]
    assert found(spark, messy, docs, item) == plain(docs, item)


def test_very_long_text(spark, messy, odd_rows):
    docs = [r for r in odd_rows if r[0] == 5]
    item = [(9, "word12 of a very long text word13 of a very")]
    got = found(spark, messy, docs, item)
    assert got == plain(docs, item) and got[0][2] > 0


def test_empty_tables(spark, messy):
    assert found(spark, messy, [(1, "a b"), (2, None)], []) == [(1, 2, 0, 0, []), (2, 0, 0, 0, [])]
    assert found(spark, messy, [], [(1, "a b")]) == []


def test_no_python_in_the_plans(spark, sf_dir, capsys):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    df = decontamination.contamination(docs, items)
    shingles = decontamination._shingles(decontamination._windows(items))
    for plan in (df, decontamination._matches(docs, shingles)):
        plan.explain("formatted")
        shown = capsys.readouterr().out
        assert "Python" not in shown and "Pandas" not in shown and "Arrow" not in shown
        assert "Cartesian" not in shown
