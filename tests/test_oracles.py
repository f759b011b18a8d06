"""Every registered query against its SQL counterpart on the small tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, difference

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows_and_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "label1", "idx", "value"]
    assert df.count() == 500 * 64
