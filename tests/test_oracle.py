"""Every query with SQL gives the SQL's rows; every other one gives rows."""

import pytest

import __spark_entry__ as entry
import oracle

SF = "/root/testdata/sf0.001"
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, plan, name):
    df = QUERIES[name](spark, SF)
    text = plan(df)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text
    assert oracle.differences(df, con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_gives_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
