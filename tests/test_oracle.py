"""Every registered query against the same query in DuckDB."""

import pytest

import __spark_entry__ as entry
from tidemark.plans import QUERIES, SQL
from tidemark.operators.layout import explain_text
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def without_all_pairs(key):
    """The query, with its plan checked for joins that compare every pair."""

    def run(spark, folder):
        df = QUERIES[key](spark, folder)
        plan = explain_text(df, "simple")
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
        return df

    return run


@pytest.mark.parametrize("key", sorted(SQL))
def test_same_as_sql(spark, con, key):
    assert compare(spark, con, FOLDER, key, without_all_pairs(key), SQL[key]) is None


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, key):
    assert QUERIES[key](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["name", "department", "total_orders", "total_items", "total_spent"]


def test_every_query_is_registered():
    assert QUERIES.keys() <= entry.queries().keys() and SQL.keys() <= entry.oracle_sql().keys()


def test_hash_sample_is_the_same_each_time(spark):
    first, second = (QUERIES["hash_sample"](spark, FOLDER).collect() for _ in range(2))
    assert sorted(first) == sorted(second)
