"""Every registered query that has an SQL twin gives the same rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from tidemark.schema import FEATURES

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, sf, name):
    text, ok = compare(spark, con, sf, name, queries()[name], SQL[name])
    assert ok, text


def test_registry_is_consistent():
    assert set(SQL) <= set(queries())


def test_entry_has_the_feature_schema(spark):
    df = entry(spark)
    assert df.columns[3:] == list(FEATURES) and len(df.columns) == 83
    assert df.count() > 0
