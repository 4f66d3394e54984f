"""Every registered query against its SQL, on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry_module
from trawlspark.plans import catalog, oracles

SF = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_module.queries()) and set(SQL) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, SF), con, SQL[name]) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() == 50
