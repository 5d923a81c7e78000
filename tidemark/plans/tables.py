"""The test tables in the roles the operators expect, with the same roles in SQL.

Only the columns and joins a query needs are asked for, so scans stay narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import money, summable, whole_cents
from tidemark.functions.times import instant
from tidemark.operators.joins import dimension_join
from tidemark.sources.files import scan_parquet


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return scan_parquet(spark, f"{folder}/{name}.parquet")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """Customer as employee record: salary and department."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation_id"),
        money("c_acctbal").alias("salary"),
        F.col("c_mktsegment").alias("department"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        money("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderpriority").alias("priority"),
    )


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines: quantity; unit price and revenue in cents."""
    rows = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        whole_cents("l_extendedprice").alias("price"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
        F.col("l_returnflag").alias("flag"),
    )
    revenue = F.col("quantity") * F.col("price")
    return rows.withColumns({"revenue": summable(revenue), "price": summable(F.col("price"))})


def order_totals(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order. Adding up the lines first leaves a hot order a single row, and the
    result already lies by order for the join that follows."""
    return lines(spark, folder).groupBy("order_id").agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("quantity"),
        F.sum("price").alias("price_sum"),
        F.sum("revenue").alias("revenue"),
    )


def customer_totals(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with orders: orders, items, spent."""
    keys = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    joined = keys.join(order_totals(spark, folder), "order_id")
    return joined.groupBy("customer_id").agg(
        F.count("*").alias("total_orders"),
        F.sum("quantity").alias("total_items"),
        F.sum("revenue").alias("total_spent"),
    )


def regions_of_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier to region. Nation and region have a fixed number of rows."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, folder, "region").select("r_regionkey", "r_name")
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return suppliers.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("supplier_id"), F.col("r_name").alias("region")
    )


def sales(spark: SparkSession, folder: str, region: bool = True, product: bool = True) -> DataFrame:
    """Order lines with the region of the supplier and the product's name and category."""
    return _described(spark, folder, lines(spark, folder), region, product)


def sales_totals(spark: SparkSession, folder: str, region: bool = True, product: bool = True, **periods: Column) -> DataFrame:
    """The same with the lines of a product and supplier added up before anything is joined.

    Sums (revenue, prices, quantity), counts (sales, priced, counted) and extremes (highest,
    lowest price) can be merged further. ``periods`` are expressions of the sale date to keep apart.
    """
    keys = ["product_id"] * product + ["supplier_id"] * region
    totals = lines(spark, folder).groupBy(*keys, *[c.alias(name) for name, c in periods.items()]).agg(
        F.sum("revenue").alias("revenue"),
        F.sum("price").alias("prices"),
        F.count("price").alias("priced"),
        F.sum("quantity").alias("quantity"),
        F.count("quantity").alias("counted"),
        F.count("*").alias("sales"),
        F.max("price").alias("highest"),
        F.min("price").alias("lowest"),
    )
    return _described(spark, folder, totals, region, product)


def _described(spark: SparkSession, folder: str, rows: DataFrame, region: bool, product: bool) -> DataFrame:
    if product:
        part = table(spark, folder, "part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("product"),
            F.col("p_type").alias("category"),
        )
        rows = dimension_join(rows, part, ["product_id"])
    if region:
        rows = dimension_join(rows, regions_of_suppliers(spark, folder), ["supplier_id"])
    return rows


def events(spark: SparkSession, folder: str) -> DataFrame:
    """User activity with a TIMESTAMP ``ts``, and ``value`` in cents."""
    return activity(table(spark, folder, "events").withColumn("ts", instant("ts")))


def activity(df: DataFrame) -> DataFrame:
    """The same columns for a batch and a streaming frame."""
    return df.select("event_id", "ts", "user_id", "event_type", summable(whole_cents("value")).alias("value"), "props")


def value() -> Column:
    """The value of an event as a record keeps it."""
    return money("value", 18)


# ---------------------------------------------------------------- the same roles in SQL

LINES = """(SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS supplier_id,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
  CAST(l_shipdate AS DATE) AS sale_date, l_returnflag AS flag,
  CAST(l_quantity AS INTEGER) * CAST(l_extendedprice AS DECIMAL(10,2)) AS revenue
  FROM lineitem) lines"""

ORDERS = """(SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
  CAST(o_totalprice AS DECIMAL(10,2)) AS price, CAST(o_orderdate AS DATE) AS order_date,
  o_orderpriority AS priority FROM orders) ord"""

CUSTOMERS = """(SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id,
  CAST(c_acctbal AS DECIMAL(10,2)) AS salary, c_mktsegment AS department FROM customer) cust"""

SALES = f"""(SELECT lines.*, r_name AS region, p_name AS product, p_type AS category
  FROM {LINES} JOIN part ON product_id = p_partkey JOIN supplier ON supplier_id = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) sales"""

EVENTS = """(SELECT event_id, ts, user_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, props
  FROM events) ev"""


def sql_cents(total: str, count: str) -> str:
    """Money sum over count rounded half up to cents, in whole-number arithmetic."""
    return (
        f"CAST((CAST(({total}) * 100 AS HUGEINT) * 2 + ({count})) // (2 * ({count})) AS DOUBLE) / 100"
    )


def sql_mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


def sql_window(size: str, column: str = "ts") -> str:
    return f"time_bucket(INTERVAL {size}, {column}, TIMESTAMP '1970-01-01')"


def sql_watermark(delay: str, where: str = "") -> str:
    """Watermark after the whole table was read: windows up to here are closed."""
    return f"(SELECT max(ts) - INTERVAL {delay} FROM events {where})"
