"""Every query with an SQL counterpart gives the same rows on the test tables."""

import pytest

import __spark_entry__ as entry
from tests.helpers import of_spark, table

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, data, name):
    expected = duck.sql(ORACLES[name])
    assert of_spark(QUERIES[name](spark, data)) == table(expected.columns, expected.fetchall())


def test_entry_has_rows(spark, data):
    assert entry.entry(spark).limit(1).count() == 1


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
