"""Known answers on a small set of customers and orders."""

from __future__ import annotations

from datetime import datetime

import pytest

from tidemark.operators.layout import explain_text
from tidemark.plans import QUERIES

# The example records.
CUSTOMERS = [
    (1, "Alice", 0, 75000.0, "Engineering"),
    (2, "Bob", 0, 85000.0, "Sales"),
    (3, "Charlie", 0, 65000.0, "Marketing"),
    (4, "Diana", 0, 70000.0, "HR"),
    (5, "Eve", 0, 80000.0, "Engineering"),
    (6, "Frank", 0, 90000.0, "Finance"),
    (7, "Grace", 0, 68000.0, "Marketing"),
    (8, "Henry", 0, 72000.0, "Engineering"),
]
ORDERS = [
    (1001, 1, "Laptop", 1, 1200.00, 15, "completed"),
    (1002, 2, "Mouse", 2, 25.50, 16, "completed"),
    (1003, 1, "Keyboard", 1, 75.00, 16, "shipped"),
    (1004, 3, "Monitor", 1, 350.00, 17, "completed"),
    (1005, 4, "Headphones", 1, 89.99, 18, "pending"),
    (1006, 2, "Webcam", 1, 120.00, 18, "completed"),
    (1007, 5, "Tablet", 1, 299.99, 19, "shipped"),
    (1008, 3, "Phone Case", 3, 15.99, 20, "completed"),
    (1009, 1, "USB Cable", 5, 12.99, 21, "completed"),
    (1010, 6, "Charger", 2, 35.00, 22, "pending"),
    (1011, 4, "Speaker", 1, 199.99, 23, "completed"),
    (1012, 2, "Desk Lamp", 1, 45.50, 24, "shipped"),
    (1013, 7, "Notebook", 10, 3.99, 25, "completed"),
    (1014, 5, "Pen Set", 2, 19.99, 26, "completed"),
    (1015, 8, "External Drive", 1, 89.00, 27, "pending"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The records in the layout of the test tables."""
    path = str(tmp_path_factory.mktemp("golden"))

    def save(name, data, schema):
        spark.createDataFrame(data, schema).write.parquet(f"{path}/{name}.parquet")

    save("customer", CUSTOMERS, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    save(
        "orders",
        [(o, c, s, q * p, datetime(2024, 1, day), "1-URGENT") for o, c, _, q, p, day, s in ORDERS],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz,"
        " o_orderpriority string",
    )
    save(
        "lineitem",
        [(o, o, 1, 1, float(q), p, 0.0, 0.0, "N", "O", datetime(2024, 1, day)) for o, _, _, q, p, day, _ in ORDERS],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string,"
        " l_shipdate timestamp_ntz",
    )
    save("part", [(o, n, "b", "t", 1, 1.0) for o, _, n, *_ in ORDERS],
         "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    return path


def result(spark, folder, key):
    return [tuple(r) for r in QUERIES[key](spark, folder).collect()]


def test_customer_order_summary(spark, folder):
    found = [(name, orders, items, spent) for name, _, orders, items, spent in result(spark, folder, "customer_order_summary")]
    assert found == [
        ("Alice", 3, 7, 1339.95), ("Charlie", 2, 4, 397.97), ("Eve", 2, 3, 339.97), ("Diana", 2, 2, 289.98),
        ("Bob", 3, 4, 216.5), ("Henry", 1, 1, 89.0), ("Frank", 1, 2, 70.0), ("Grace", 1, 10, 39.9),
    ]


def test_salary_by_department(spark, folder):
    found = {r[0]: (round(r[1], 6), *r[2:]) for r in result(spark, folder, "salary_stats_by_segment")}
    assert found == {
        "Finance": (90000.0, 90000.0, 90000.0, 1),
        "Sales": (85000.0, 85000.0, 85000.0, 1),
        "Engineering": (75666.666667, 80000.0, 72000.0, 3),
        "HR": (70000.0, 70000.0, 70000.0, 1),
        "Marketing": (66500.0, 68000.0, 65000.0, 2),
    }


def test_orders_by_status(spark, folder):
    found = {s: (n, q, round(p, 6), r, v) for s, n, q, p, r, v in result(spark, folder, "order_stats_by_status")}
    assert found == {
        "completed": (9, 26, 216.494444, 2113.79, 234.87),
        "shipped": (3, 3, 140.163333, 420.49, 140.16),
        "pending": (3, 4, 71.33, 248.99, 83.0),
    }


def test_spending_by_department(spark, folder):
    assert result(spark, folder, "segment_spending") == [
        ("Engineering", 1768.92), ("Marketing", 437.87), ("HR", 289.98), ("Sales", 216.5), ("Finance", 70.0),
    ]


def test_every_customer_ordered(spark, folder):
    assert result(spark, folder, "customers_without_orders") == []


def test_repeat_customers_and_favourite(spark, folder):
    assert sorted(result(spark, folder, "sql_repeat_customers")) == [(1, 3), (2, 3)]
    assert result(spark, folder, "most_popular_product") == [("Notebook", 10)]
    assert {r[1] for r in result(spark, folder, "top3_customers")} == {"Alice", "Charlie", "Eve"}


def test_users_are_distinct_before_they_are_sketched(spark, tmp_path):
    events = [(1, "a"), (1, "a"), (2, "a"), (None, "a"), (None, "b"), (3, None), (3, None)]
    spark.createDataFrame(events, "user_id bigint, event_type string").write.parquet(f"{tmp_path}/events.parquet")
    found = QUERIES["approx_users"](spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([("a", 2, True), ("b", 0, True), (None, 1, True)], key=repr)
    plan = explain_text(found, "simple").split("\n")
    assert any("approx_count_distinct" in line for line in plan)
    assert not any("approx_count_distinct" in line and "user_id" in line.split("functions=")[0] for line in plan)
