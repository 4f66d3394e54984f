"""Registered queries of the training-data operators: SQL where there is one, rows and columns elsewhere."""

import oracle
import pytest

from trawlspark.llm import queries as llm

SF = "/root/testdata/sf0.001"


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries()) == list(range(1, 14))
    assert set(llm.oracle_sql()) <= set(llm.queries())


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_equals_sql(spark, name):
    assert oracle.difference(llm.queries()[name](spark, SF), oracle.connect(SF), llm.oracle_sql()[name]) is None
