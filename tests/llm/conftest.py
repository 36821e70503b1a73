"""Small tables with the awkward cases that every operator must stand."""

from __future__ import annotations

import pytest

from stateloom.llm.shared import importable

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """Rows of text to a documents table; ids count from 1."""

    def make(texts, **columns):
        rows = [(i, t, columns.get("lang", "en"), f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts, 1)]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, equal texts, and clashing column names."""
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    rows = [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, long, "en", "a", len(long)), (4, long, "en", "b", len(long)),
        (5, "one two three", "en", None, 13), (5, "one two three", "en", None, 13), (None, "a text without an id and words enough", None, "b", 3),
        (6, " \n\t ", "en", "a", 4), (7, "12345 67890 !!!", None, "c", 15), (8, "ünï cödé ßtraße Ωμέγα", "de", "c", 21),
    ]
    made = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("size", "taken", "mixed", "class", "n_hit", "items", "lang_pred", "score", "row_doc", "Judged", "node"):
        made = made.selectExpr("*", f"'kept' as {name}")
    return made
