"""Every query with SQL against DuckDB on the smallest tables, and the shape of its plan."""

import contextlib
import io

import pytest
from compare import connect, differences

from plumbline.plans.catalog import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert operator not in shown.getvalue()
    assert differences(df, con, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() == 4
    assert set(contract.oracle_sql()) <= set(contract.queries())
