import pytest

import __spark_entry__ as registry
from oracle import assert_same


OWN = [query.__name__ for query in registry._QUERIES]


def test_every_query_has_sql():
    assert set(OWN) <= set(registry.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, small, name):
    assert_same(registry.queries()[name](spark, small), registry.oracle_sql()[name], small)


def test_entry(spark):
    assert registry.entry(spark).columns == ["store_id", "transactions", "total_revenue", "not_added"]
