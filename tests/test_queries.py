"""Every registered query against its DuckDB text on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry

FOLDER = f"{compare.TESTDATA}/sf0.001"
QUERIES, SQL = {name: entry.queries()[name] for name in entry.REGISTRY}, entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, name):
    assert compare.compare(spark, con, name, QUERIES[name], SQL.get(name), FOLDER) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns == ["code", "occurrences", "pct"]
    assert not entry.entry(spark).isEmpty()


def test_no_query_lacks_sql():
    assert set(QUERIES) <= set(SQL)
