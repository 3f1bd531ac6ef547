"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from check_queries import compare, views
from tests.conftest import SMALL, plan

ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return views(SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    compare(df, con, ORACLES.get(name))
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["cuisine", "city", "order_count", "customers", "revenue", "sales_rank"]
    assert df.count() >= 18


def test_names():
    names = entry.queries()
    assert set(ORACLES) <= set(names)
