"""The corpus queries that SQL can express, against their SQL."""

from __future__ import annotations

import pytest

from tests.conftest import DATA
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    sql = duck.execute(ORACLES[name])
    names = [c[0] for c in sql.description]
    assert sorted(names) == sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    assert got == sorted(sql.fetchall(), key=repr)


def test_there_is_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
