"""Every registered query against its SQL on the smallest tables, and its plan."""

import pytest

from cairnfield.plans import catalog
from tests.conftest import DATA, same

QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, f"{DATA}/sf0.001")
    same(df, duck, SQL[name])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_without_sql(spark, name):
    assert QUERIES[name](spark, f"{DATA}/sf0.001").count() > 0


def test_entry():
    import __spark_entry__ as e

    assert set(catalog.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_twice_the_same(spark):
    a, b = (QUERIES["tiered_nearest"](spark, f"{DATA}/sf0.001").collect() for _ in range(2))
    assert sorted(a) == sorted(b)
