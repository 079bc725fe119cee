from __future__ import annotations

import pytest

ODD = "doc_id bigint, text string, lang string, score double, rep bigint, key string, piece int, _doc int, n_lines int"


@pytest.fixture
def docs_of(spark):
    """Documents from (id, text) or (id, text, lang), with extra columns of clashing names."""

    def build(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", 0.5, 7, "k", 1, 2, 3) for r in rows]
        return spark.createDataFrame(full, ODD)

    return build


@pytest.fixture
def odd_rows():
    """Null ids and texts, empty and blank texts, repeated rows, a very long text."""
    return [
        (1, "the cat sat on the mat and then it went away again"),
        (2, None),
        (3, ""),
        (4, " \n\t "),
        (5, "one"),
        (5, "one"),
        (None, "a row without an id that has some words"),
        (None, None),
        (6, "word " * 60_000),
        (7, "é😀 İ ﬁ \x00 end"),
    ]
