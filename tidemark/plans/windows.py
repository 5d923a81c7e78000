"""Ordered window functions over whole tables; hot keys are balanced by range slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import slices
from tidemark.plans import tables as t
from tidemark.plans.registry import query


@query(f"""
SELECT customer_id, department, row_number() OVER (PARTITION BY department ORDER BY salary, customer_id) AS row_num
FROM {t.CUSTOMERS}
""")
def row_number_by_segment(spark: SparkSession, d: str) -> DataFrame:
    keys, order = ["department"], ["salary", "customer_id"]
    rows = t.customers(spark, d).select("customer_id", "department", "salary")
    numbered = slices.keyed_numbers(rows, keys, order, "row_num")
    return numbered.select("customer_id", "department", F.col("row_num").cast("bigint").alias("row_num"))


@query(f"""
SELECT customer_id, CAST(lag(salary) OVER (PARTITION BY department ORDER BY salary, customer_id) AS DOUBLE) AS prev_salary
FROM {t.CUSTOMERS}
""")
def prev_salary(spark: SparkSession, d: str) -> DataFrame:
    keys, order = ["department"], ["salary", "customer_id"]
    rows = t.customers(spark, d).select("customer_id", "department", "salary")
    shifted = slices.keyed_previous(rows, keys, order, "salary", "prev_salary")
    return shifted.select("customer_id", F.col("prev_salary").cast("double").alias("prev_salary"))


@query(f"""
SELECT order_id, status, CAST(rank() OVER (PARTITION BY status ORDER BY price DESC) AS BIGINT) AS price_rank FROM {t.ORDERS}
""")
def rank_orders_by_status(spark: SparkSession, d: str) -> DataFrame:
    rows = t.orders(spark, d).select("order_id", "status", "price")
    return slices.keyed_ranks(rows, ["status"], "price", "price_rank").select("order_id", "status", "price_rank")


@query(f"""
SELECT order_id, CAST(sum(price) OVER (ORDER BY order_date, order_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_revenue FROM {t.ORDERS}
""")
def running_revenue(spark: SparkSession, d: str) -> DataFrame:
    """Running total over the whole table."""
    order = ["order_date", "order_id"]
    rows = t.orders(spark, d).select("order_id", "order_date", "price")
    summed = slices.running_sum(slices.ordered_slices(rows, [], order), [], order, F.col("price"), "running")
    return summed.select("order_id", F.col("running").cast("double").alias("running_revenue"))


@query(f"""
SELECT order_id, CAST(sum(price) OVER (PARTITION BY customer_id ORDER BY order_date, order_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running_spend FROM {t.ORDERS}
""")
def running_spend_by_customer(spark: SparkSession, d: str) -> DataFrame:
    keys, order = ["customer_id"], ["order_date", "order_id"]
    rows = t.orders(spark, d).select("order_id", "customer_id", "order_date", "price")
    summed = slices.keyed_sum(rows, keys, order, F.col("price"), "running")
    return summed.select("order_id", F.col("running").cast("double").alias("running_spend"))


@query(f"""
SELECT order_id, CAST(price - lag(price) OVER (ORDER BY order_date, order_id) AS DOUBLE) AS price_diff FROM {t.ORDERS}
""")
def price_diff(spark: SparkSession, d: str) -> DataFrame:
    """Difference to the price of the order before, over the whole table."""
    order = ["order_date", "order_id"]
    rows = t.orders(spark, d).select("order_id", "order_date", "price")
    shifted = slices.previous(slices.ordered_slices(rows, [], order), [], order, "price", "before")
    return shifted.select("order_id", (F.col("price") - F.col("before")).cast("double").alias("price_diff"))
