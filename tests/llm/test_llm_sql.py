"""Queries that SQL can express, against DuckDB on the smallest tables."""

import compare
import pytest

from gristmill.llm.queries import QUERIES, SQL

FOLDER = f"{compare.TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert compare.compare(spark, compare.oracle(FOLDER), name, QUERIES[name], SQL[name], FOLDER) is None


def test_one_query_for_each_operator():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
