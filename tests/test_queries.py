"""Every named query against DuckDB's answer to its SQL counterpart."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry
from assaymill.plans import catalog

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
