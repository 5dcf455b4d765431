"""Every registered query against its SQL."""

import pytest
from compare import compare, connect

import __spark_entry__ as contract
from siteloom.plans import oracle, queries

SQL, QUERIES = oracle.statements(), queries.registry()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert QUERIES.keys() <= contract.queries().keys() and SQL.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    difference, _ = compare(QUERIES[name](spark, sf_dir), con, SQL[name])
    assert difference == ""


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
