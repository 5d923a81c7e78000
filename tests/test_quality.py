from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from tidemark import schemas
from tidemark.operators import quality as q
from tests.conftest import rows

CUSTOMER = "customer_id int, name string, age int, city string, salary decimal(10,2), department string"
ORDER = (
    "order_id int, customer_id int, product_name string, quantity int, price decimal(12,4), order_date date, status string"
)


def customers(spark, *data):
    return q.validate(spark.createDataFrame(list(data), CUSTOMER), q.customer_rules())


def orders(spark, *data):
    return q.validate(spark.createDataFrame(list(data), ORDER), q.order_rules())


def errors(validated):
    return [r[q.ERRORS] for r in validated.collect()]


BATCH = [
    (1, "Alice", 25, "NYC", Decimal(75000), "Engineering"),
    (2, "Bob", 30, "SF", Decimal(85000), "Sales"),
    (3, "", -5, None, Decimal(-1000), "Invalid"),
    (4, "Diana", 28, "Boston", Decimal(70000), "HR"),
]


def test_summary_of_a_batch(spark):
    validated = customers(spark, *BATCH)
    assert tuple(q.summary(validated).first()) == (4, 3, 1, 0.75)
    assert [r["customer_id"] for r in q.first_rejected(validated, ["customer_id"]).collect()] == [3]
    assert len(errors(q.rejected(validated))[0]) == 4
    report = dict(rows(q.error_report(validated)))
    assert report["Field 'name': String should have at least 1 character"] == 1
    assert report["Field 'age': Input should be greater than or equal to 18"] == 1


def test_summary_of_nothing(spark):
    assert tuple(q.summary(customers(spark).filter("false")).first()) == (0, 0, 0, 0.0)


def test_strict_batch_raises(spark):
    validated = customers(spark, *BATCH)
    with pytest.raises(q.InvalidData, match="failed with 1 errors"):
        q.require_valid(validated, ["customer_id"])
    assert q.require_valid(customers(spark, BATCH[0]), ["customer_id"]).count() == 1


def test_cleaning_keeps_only_the_right_case(spark):
    raw = [
        (1, "  ALICE JOHNSON  ", None, "new york", None, "engineering"),
        (2, "bob smith", None, "  San Francisco  ", None, "Sales"),
        (3, "Charlie", None, "CHICAGO", None, "marketing"),
    ]
    df = spark.createDataFrame(raw, CUSTOMER).na.fill({"age": q.DEFAULT_AGE, "salary": q.DEFAULT_SALARY})
    kept = q.accepted(q.validate(df, q.customer_rules()))
    assert rows(kept) == [(2, "Bob Smith", 30, "San Francisco", Decimal("50000.00"), "Sales")]


def test_blank_name_passes_length_but_not_the_blank_test(spark):
    assert errors(customers(spark, (1, "   ", None, None, None, None))) == [
        ["Field 'name': Value error, Name cannot be empty or whitespace"]
    ]


def test_limits_are_inclusive(spark):
    good = [(1, "a" * 100, 18, "c" * 50, Decimal(0), None), (2, "b", 120, "", None, "Finance")]
    assert errors(customers(spark, *good)) == [[], []]
    bad = [(0, "a" * 101, 121, "c" * 51, Decimal("-0.01"), "HR ")]
    assert len(errors(customers(spark, *bad))[0]) == 6


def test_missing_required_fields(spark):
    assert errors(customers(spark, (None, None, None, None, None, None))) == [
        ["Field 'customer_id': Field required", "Field 'name': Field required"]
    ]


def test_order_total(spark):
    validated = orders(
        spark,
        (1001, 1, "  expensive laptop  ", 10, Decimal("1200.00"), None, "completed"),
        (1002, 1, "laptop", 2, Decimal("1200.00"), None, "completed"),
        (1003, 1, "exact", 10, Decimal("1000.00"), None, "completed"),
    )
    found = errors(validated)
    assert found[1:] == [[], []]
    assert found[0] == ["Value error, Order total $12000.00 exceeds maximum allowed ($10,000)"]
    assert [r["product_name"] for r in validated.collect()] == ["Expensive Laptop", "Laptop", "Exact"]


def test_price_is_rounded_half_even_before_the_total(spark):
    validated = orders(
        spark,
        (1, 1, " laptop ", 2, Decimal("1200.999"), None, None),
        (2, 1, "   ", 1, Decimal("0.125"), None, None),
        (3, 1, "x", 1_000_000, Decimal("0.004"), None, None),  # rounds to 0: the total is not tested
        (4, 1, "x", 1, Decimal("0.135"), None, "Pending"),
    )
    found = validated.orderBy("order_id").collect()
    assert [r["price"] for r in found[:3]] == [Decimal("1201.00"), Decimal("0.12"), Decimal("0.00")]
    assert [r["product_name"] for r in found[:2]] == ["Laptop", ""]
    assert [r["status"] for r in found[:3]] == ["pending"] * 3
    assert [len(r[q.ERRORS]) for r in found] == [0, 0, 0, 1]


def test_nested_records(spark):
    user = {"user_id": 1, "name": "a", "email": "a@b.co", "preferences": None}
    item = {"product_id": "p", "quantity": 1, "price": Decimal("1.00")}
    order = {"order_id": 1, "items": [item], "order_date": datetime(2024, 1, 1), "total": Decimal("1.00")}
    records = [
        (1, user, [order], {"k": "v"}),
        (2, {**user, "email": None}, None, None),
        (3, {**user, "email": "a@b"}, [order], None),
        (4, user, [order, {**order, "items": []}], None),
        (5, user, [order, {**order, "items": [item, {**item, "quantity": 0}]}], None),
        (0, {**user, "user_id": 0, "name": "", "email": "x"}, [{**order, "order_id": 0, "total": Decimal("0.00")}], None),
    ]
    df = spark.createDataFrame(records, schemas.declared("nested"))
    found = {r["id"]: r[q.ERRORS] for r in q.validate(df, q.nested_rules()).collect()}
    assert found[1] == found[2] == []
    assert [e.split("'")[1] for e in found[0]] == [
        "id", "user_info.user_id", "user_info.name", "user_info.email", "orders.0.order_id", "orders.0.total"
    ]
    assert found[5][0].startswith("Field 'orders.1.items.1.quantity'")
    assert "email" in found[3][0] and "at least 1 item" in found[4][0] and "quantity" in found[5][0]


def test_every_row_is_accepted_or_rejected(spark, tmp_path):
    validated = customers(spark, *BATCH)
    assert q.accepted(validated).count() + q.rejected(validated).count() == 4
    path = str(tmp_path / "split")
    q.write_split(validated, path)
    assert rows(spark.read.parquet(path).groupBy("valid").count()) == [("false", 1), ("true", 3)]


def test_nested_schema_matches_a_scan_and_sees_missing_members(spark, tmp_path):
    from tidemark import schemas

    kind = schemas.declared("nested")
    good = spark.createDataFrame([(1, (5, "n", None, None), [], {"a": "b"})], "id int, user_info " + kind["user_info"].dataType.simpleString() + ", orders " + kind["orders"].dataType.simpleString() + ", metadata map<string,string>")
    good.write.parquet(str(tmp_path / "n"))
    assert schemas.matches(spark.read.parquet(str(tmp_path / "n")), kind)
    bad = good.selectExpr("id", "named_struct('user_id', cast(null as int), 'name', 'x', 'email', 'e', 'preferences', user_info.preferences) user_info", "orders", "metadata")
    assert schemas.null_counts(bad, kind) == {"user_info": 1}
