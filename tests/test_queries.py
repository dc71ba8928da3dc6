"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import DATA
from tidemark.workloads.queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    sql = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in sql.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in sql.fetchall()), key=repr)
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
