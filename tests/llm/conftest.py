from __future__ import annotations

import pytest

# Names that the operators use for columns of their own.
CLASHES = {"score": 1.5, "key": 7, "label": 3, "row": "r", "prints": 2, "place": "p", "statistics": 0}


@pytest.fixture(scope="session")
def messy(spark):
    """Builds a table of (doc_id, text) rows with extra columns that clash with inner names."""

    def build(rows):
        kinds = "doc_id long, text string, lang string, source string, n_chars long"
        kinds += ", score double, key int, label int, row string, prints int, place string"
        kinds += ", statistics int"
        full = [
            (i, t, None, "src0", None if t is None else len(t), *CLASHES.values()) for i, t in rows
        ]
        return spark.createDataFrame(full, kinds)

    return build


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, letters of several scripts."""
    long_text = " ".join(f"word{i % 977} of a very long text" for i in range(30_000))
    return [
        (1, "One plain text, of a few words.\nAnd a second line."),
        (2, None),
        (3, ""),
        (4, "   \n\n  "),
        (5, long_text),
        (6, "One plain text, of a few words.\nAnd a second line."),
        (6, "One plain text, of a few words.\nAnd a second line."),
        (7, "ÉTÉ été ß ΑΣ и 🎉 \x00 a\tb\x0bc d"),
        (None, "A text without an id."),
        (None, "A text without an id."),
        (None, None),
        (-8, "negative id"),
    ]


@pytest.fixture(scope="session")
def write_tables(spark, tmp_path_factory):
    """Writes named DataFrames as the folder of tables that the queries read."""

    def write(**tables):
        folder = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write
