"""Every catalogue query with SQL gives the same rows in DuckDB (smallest scale)."""

import pytest

import __spark_entry__ as entry
from compare import compare, duck

@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_sql(spark, con, sf_dir, name):
    ok, message = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), sf_dir)
    assert ok, message


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["split", "diagnosis", "rows", "positives", "mean_lace"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
