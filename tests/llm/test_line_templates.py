"""Line templates against a plain count over all lines."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from veracast.llm import line_templates
from veracast.llm.line_templates import drop_recurring_lines, line_paths


def plain(rows, min_docs=3):
    docs_of, home = defaultdict(set), {}
    for place, (doc_id, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            for template in (line_paths(line) or (0, []))[1]:
                docs_of[template].add(place)
                if doc_id is not None:
                    home[template] = min(doc_id, home.get(template, doc_id))
    out = []
    for doc_id, text in rows:
        kept = [
            line
            for line in (text or "").split("\n")
            if not any(
                len(docs_of[t]) >= min_docs and t in home and (doc_id is None or doc_id > home[t])
                for t in (line_paths(line) or (0, []))[1]
            )
        ]
        out.append((doc_id, None if text is None else "\n".join(kept)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.row.doc_id, r.text) for r in drop_recurring_lines(df).collect()), key=str)


def test_variable_fields_share_a_template():
    one = line_paths("Posted by John Smith on 2021-03-04 in the news section today")
    two = line_paths("Posted by Mary Brown on 2022-11-30 in the news section today")
    assert one[0] == two[0] and set(one[1]) & set(two[1]) and one[1][0] != two[1][0]
    other = line_paths("Posted by John Smith off 2021-03-04 at some olds section morrow")
    assert not set(one[1]) & set(other[1])


def test_short_and_variable_lines_have_no_template():
    for line in ("", "one two", "12 34 56 78", "a 1 2 b"):
        assert line_paths(line) is None
    assert line_paths("three short words") is not None


def test_recurring_lines_stay_in_the_first_document(messy):
    rows = [(i, f"Text of its own number {'abcdefgh'[i] * 4}\nAll rights are reserved here.\nEnd {i}") for i in range(8)]
    got = dict(found(messy(rows)))
    assert "reserved" in got[0] and not any("reserved" in got[i] for i in range(1, 8))
    assert all("own number" in t for t in got.values())


def test_templates_with_names(messy):
    names = ["Ada", "Bob", "Cid", "Dan"]
    rows = [(i, f"This page was last edited by {n} of our office staff\nbody {n} text {n * 3}") for i, n in enumerate(names)]
    got = dict(found(messy(rows)))
    assert "edited" in got[0] and not any("edited" in got[i] for i in (1, 2, 3))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_lines(messy, odd_rows, seed):
    draw = random.Random(seed)
    lines = [" ".join(draw.choice("ab c d1 e f".split()) for _ in range(draw.randint(1, 10))) for _ in range(25)]
    rows = [(draw.choice([*range(30), None]), "\n".join(draw.choice(lines) for _ in range(draw.randint(0, 6)))) for _ in range(40)]
    # Rows with an id twice stand for two documents.
    rows += [r for r in odd_rows if r[0] != 5]
    assert found(messy(rows)) == plain(rows)


def test_very_long_text_and_hot_line(messy, odd_rows):
    rows = [r for r in odd_rows if r[0] == 5]
    rows += [(100 + i, f"the same line everywhere in the corpus\nother {'xy'[i % 2] * (i + 1)} line") for i in range(200)]
    assert found(messy(rows)) == plain(rows)


def test_nothing_and_other_columns(messy):
    assert drop_recurring_lines(messy([])).collect() == []
    df = messy([(1, "a b c")])
    assert drop_recurring_lines(df).select("row.*").columns == df.columns


def test_leaves_prune_before_templates(messy, monkeypatch):
    """Lines whose leaf is rare never get their templates counted."""
    staged = {}
    plain_stage = line_templates.stage

    def keep(df, label):
        staged[label] = plain_stage(df, label)
        return staged[label]

    monkeypatch.setattr(line_templates, "stage", keep)
    rows = [(i, f"start{i % 50}x word{'z' * i} and then some more words here") for i in range(60)]
    drop_recurring_lines(messy(rows)).collect()
    assert staged["line-candidates"].count() < 6 * 60
