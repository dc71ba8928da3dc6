from __future__ import annotations

import duckdb
import pytest

from tests.conftest import DATA

LONG = "lorem ipsum dolor " * 60_000
# Columns named as the operators name their own.
EXTRA = ("score", "n_tokens", "component_id", "copies", "_size", "_key", "blob", "s1", "n", "fragment", "_kept", "_own_0", "size", "held_out")
COLUMNS = ["doc_id", "text", "lang", "source", *EXTRA]


@pytest.fixture
def odd_docs(spark):
    """Null ids, texts, languages and sources, empty and very long texts, repeated rows."""
    rows = [
        (1, "The cat sat on the mat and looked at the dog.", "en", "a"),
        (1, "The cat sat on the mat and looked at the dog.", "en", "a"),
        (2, None, None, None),
        (3, "", "en", "b"),
        (4, LONG, "la", "b"),
        (5, "   \n\t ", "en", "b"),
        (None, "Someone without an id wrote this short text here.", "en", None),
        (None, None, "en", "c"),
        (6, "the cat SAT on the mat and looked at the dog.", "en", "c"),
        (7, "1234 !!", "de", "c"),
        (8, "Größe é 日本語 😀 ok", "de", "a"),
        (8, "another text of the same id", "de", "a"),
    ]
    schema = "doc_id bigint, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in EXTRA)
    return spark.createDataFrame([(*r, *["x"] * len(EXTRA)) for r in rows], schema)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.where("doc_id = -1")


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) of the smallest documents table."""
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{DATA}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="session")
def duck():
    from pathlib import Path

    con = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con
