import pytest

import __spark_entry__ as entry
from compare import difference, duck

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert difference(entry.queries()[name](spark, SMALL), con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["store_id", "revenue"] and rows.count() == 10
