"""Every registered query against the same result as SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from compare import connect, differences
from dqspark import registry

# Queries for training data have tests of their own.
QUERIES = {n: q for n, q in entry_module.queries().items() if n in registry.QUERIES}
ORACLES = {n: s for n, s in entry_module.oracle_sql().items() if n in registry.QUERIES}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["user_id", "category", "sales_amount"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_runs(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0
