"""Projection, filter, join, aggregate and SQL queries over the retail tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import cents_mean, cents_ratio, cents_rounded, cents_total, cents_value, mean, total
from tidemark.functions import times
from tidemark.functions.text import json_number
from tidemark.operators import joins, sketches
from tidemark.plans import tables as t
from tidemark.plans.registry import query
from tidemark.session import written

# Salary tiers, bonus share.
HIGH_SALARY, MEDIUM_SALARY = 80000, 65000
BONUS = 0.15
# Actions that count as shopping.
SHOPPING = ["purchase", "click"]


# ------------------------------------------------------------------- projection, filter


@query(f"""
SELECT name, CAST(salary AS DOUBLE) AS salary, CAST(salary AS DOUBLE) * 0.15 AS annual_bonus,
  CAST(salary AS DOUBLE) + CAST(salary AS DOUBLE) * 0.15 AS total_compensation
FROM {t.CUSTOMERS}
""")
def project_compensation(spark: SparkSession, d: str) -> DataFrame:
    salary = F.col("salary").cast("double")
    rows = t.customers(spark, d).select("name", salary.alias("salary"))
    rows = rows.withColumn("annual_bonus", F.col("salary") * BONUS)
    return rows.withColumn("total_compensation", F.col("salary") + F.col("annual_bonus"))


@query("SELECT n_nationkey AS nation_id, n_name AS nation FROM nation")
def rename_drop(spark: SparkSession, d: str) -> DataFrame:
    nation = t.table(spark, d, "nation").withColumnRenamed("n_name", "nation")
    return nation.withColumnRenamed("n_nationkey", "nation_id").drop("n_regionkey")


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_segment(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return rows.select("c_custkey", "c_name", "c_mktsegment")


@query("""
SELECT c_custkey, c_acctbal FROM customer
WHERE c_acctbal > 7000 AND (c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY')
""")
def filter_salary(spark: SparkSession, d: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    keep = (F.col("c_acctbal") > 7000) & ((segment == "BUILDING") | (segment == "MACHINERY"))
    return t.table(spark, d, "customer").filter(keep).select("c_custkey", "c_acctbal")


@query("SELECT event_id, user_id, event_type FROM events WHERE event_type IN ('purchase', 'click')")
def filter_actions(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "events").filter(F.col("event_type").isin(SHOPPING))
    return rows.select("event_id", "user_id", "event_type")


@query("""
SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE k IS NULL) AS null_k, count(*) FILTER (WHERE k IS NOT NULL) AS known_k,
  count(*) FILTER (WHERE missing IS NULL) AS null_missing, count(*) FILTER (WHERE isnan(value)) AS nan_value
FROM (SELECT TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.none') AS missing, value FROM events) e
""")
def null_report(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "events").select(
        json_number(F.col("props"), "k").alias("k"),
        F.get_json_object("props", "$.none").alias("missing"),
        "value",
    )
    return rows.agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("k").isNull()).alias("null_k"),
        F.count_if(F.col("k").isNotNull()).alias("known_k"),
        F.count_if(F.isnull("missing")).alias("null_missing"),
        F.count_if(F.isnan("value")).alias("nan_value"),
    )


@query(f"""
SELECT customer_id, CASE WHEN salary * 10 > {HIGH_SALARY} THEN 'High'
  WHEN salary * 10 > {MEDIUM_SALARY} THEN 'Medium' ELSE 'Low' END AS salary_category
FROM {t.CUSTOMERS}
""")
def salary_category(spark: SparkSession, d: str) -> DataFrame:
    """Tiers of a yearly salary; the balance column stands for a tenth of it."""
    yearly = F.col("salary") * 10
    tier = F.when(yearly > HIGH_SALARY, "High").when(yearly > MEDIUM_SALARY, "Medium").otherwise("Low")
    return t.customers(spark, d).select("customer_id", tier.alias("salary_category"))


# ----------------------------------------------------------------------------- aggregates


@query(f"""
SELECT department, {t.sql_mean('salary')} AS avg_salary, CAST(max(salary) AS DOUBLE) AS max_salary,
  CAST(min(salary) AS DOUBLE) AS min_salary, count(*) AS employee_count
FROM {t.CUSTOMERS} GROUP BY department ORDER BY avg_salary DESC
""")
def salary_stats_by_segment(spark: SparkSession, d: str) -> DataFrame:
    salary = F.col("salary")
    stats = t.customers(spark, d).groupBy("department").agg(
        mean(salary).alias("avg_salary"),
        F.max(salary).cast("double").alias("max_salary"),
        F.min(salary).cast("double").alias("min_salary"),
        F.count("*").alias("employee_count"),
    )
    return stats.orderBy(F.desc("avg_salary"))


@query(f"""
SELECT status, count(*) AS order_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  CAST(sum(lines.price) AS DOUBLE) / count(*) AS avg_price, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
  {t.sql_cents('sum(revenue)', 'count(*)')} AS avg_order_value
FROM {t.ORDERS} JOIN {t.LINES} USING (order_id) GROUP BY status
""")
def order_stats_by_status(spark: SparkSession, d: str) -> DataFrame:
    per_order = t.orders(spark, d).select("order_id", "status").join(t.order_totals(spark, d), "order_id")
    sums = per_order.groupBy("status").agg(
        F.sum("lines").alias("order_count"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("price_sum").alias("prices"),
        F.sum("revenue").alias("revenue"),
    )
    return sums.select(
        "status", "order_count", "total_quantity",
        cents_ratio(F.col("prices"), F.col("order_count")).alias("avg_price"),
        cents_value("revenue").alias("total_revenue"),
        cents_rounded(F.col("revenue"), F.col("order_count")).alias("avg_order_value"),
    )


@query(f"""
SELECT p_name AS product_name, CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM {t.LINES} JOIN part ON product_id = p_partkey GROUP BY p_name
""")
def revenue_by_product(spark: SparkSession, d: str) -> DataFrame:
    """Lines are added up per product number before they meet the product table."""
    per_part = t.lines(spark, d).groupBy("product_id").agg(F.sum("revenue").alias("revenue"))
    part = t.table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), "p_name")
    by_name = per_part.join(part, "product_id").groupBy(F.col("p_name").alias("product_name"))
    return by_name.agg(cents_total(F.col("revenue")).alias("total_revenue")).orderBy(F.desc("total_revenue"))


@query(f"""
SELECT department, CAST(sum(revenue) AS DOUBLE) AS total_spending
FROM {t.CUSTOMERS} JOIN {t.ORDERS} USING (customer_id) JOIN {t.LINES} USING (order_id) GROUP BY department
""")
def segment_spending(spark: SparkSession, d: str) -> DataFrame:
    people = t.customers(spark, d).select("customer_id", "department")
    spent = t.customer_totals(spark, d).join(people, "customer_id")
    by_department = spent.groupBy("department").agg(cents_total(F.col("total_spent")).alias("total_spending"))
    return by_department.orderBy(F.desc("total_spending"))


@query(f"""
SELECT count(*) AS total_count, CAST(sum(price) AS DOUBLE) AS total_price, {t.sql_mean('price')} AS avg_price,
  CAST(max(price) AS DOUBLE) AS max_price, CAST(min(price) AS DOUBLE) AS min_price FROM {t.ORDERS}
""")
def global_stats(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("price")
    return t.orders(spark, d).agg(
        F.count("*").alias("total_count"),
        total(price).alias("total_price"),
        mean(price).alias("avg_price"),
        F.max(price).cast("double").alias("max_price"),
        F.min(price).cast("double").alias("min_price"),
    )


@query("""
SELECT p_brand, CAST(max(p_retailprice) AS DOUBLE) AS top_price, CAST(avg(p_size) AS DOUBLE) AS avg_size
FROM part GROUP BY p_brand
""")
def dict_agg(spark: SparkSession, d: str) -> DataFrame:
    grouped = t.table(spark, d, "part").groupBy("p_brand").agg({"p_retailprice": "max", "p_size": "avg"})
    return grouped.select(
        "p_brand", F.col("max(p_retailprice)").alias("top_price"), F.col("avg(p_size)").alias("avg_size")
    )


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC")
def key_distribution(spark: SparkSession, d: str) -> DataFrame:
    counts = t.table(spark, d, "events").groupBy("event_type").count().withColumnRenamed("count", "n")
    return counts.orderBy(F.desc("n"))


@query(f"""
SELECT event_type AS pattern, count(*) AS record_count, count(DISTINCT user_id) AS distinct_users,
  {t.sql_mean('value')} AS avg_amount FROM {t.EVENTS} GROUP BY event_type
""")
def pattern_profile(spark: SparkSession, d: str) -> DataFrame:
    return t.events(spark, d).groupBy(F.col("event_type").alias("pattern")).agg(
        F.count("*").alias("record_count"),
        F.count_distinct("user_id").alias("distinct_users"),
        cents_mean(F.col("value")).alias("avg_amount"),
    )


@query("""
SELECT event_type, count(DISTINCT user_id) AS exact_users, TRUE AS sketch_is_close FROM events GROUP BY event_type
""")
def approx_users(spark: SparkSession, d: str) -> DataFrame:
    """Sketch-based count of users, held against the exact one: off by 5 % at most."""
    # Users are made distinct first, which a sketch does not notice. With both counts over the rows, Spark would keep a sketch for
    # every user of a type.
    users = t.table(spark, d, "events").select("event_type", "user_id").distinct()
    counted = users.groupBy("event_type").agg(
        F.approx_count_distinct("user_id", 0.02).alias("unique_users"), F.count("user_id").alias("exact_users")
    )
    off = F.abs(F.col("unique_users") - F.col("exact_users"))
    close = off <= F.greatest(F.lit(1.0), F.lit(0.05) * F.col("exact_users"))
    return counted.select("event_type", "exact_users", close.alias("sketch_is_close"))


@query("""
SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, count(DISTINCT user_id) AS exact_users, TRUE AS day_is_close,
  count(DISTINCT date_trunc('hour', ts)) AS hours
FROM events GROUP BY CAST(ts AS DATE), event_type
""")
def sketched_daily_users(spark: SparkSession, d: str) -> DataFrame:
    """Users per day from stored sketches per hour, held against the exact count: off by 5 % at most."""
    rows = t.events(spark, d)
    hour = F.date_trunc("hour", times.plain("ts"))
    stored = written(sketches.distinct_sketches(rows, hour, ["event_type"], "user_id"), "hourly-users")
    days = sketches.united(stored, F.to_date("period"), ["event_type"])
    days = days.select(F.col("period").alias("day"), "event_type", F.col("rows").alias("n"), F.col("parts").alias("hours"), sketches.estimate().alias("users"))
    exact = rows.groupBy(F.to_date(times.plain("ts")).alias("day"), "event_type").agg(F.count_distinct("user_id").alias("exact_users"))
    off = F.abs(F.col("users") - F.col("exact_users"))
    close = off <= F.greatest(F.lit(1.0), F.lit(0.05) * F.col("exact_users"))
    return days.join(exact, ["day", "event_type"]).select("day", "event_type", "n", "exact_users", close.alias("day_is_close"), "hours")


@query(f"""
SELECT user_id, count(*) AS n, {t.sql_mean('value')} AS avg_value
FROM {t.EVENTS} GROUP BY user_id HAVING count(*) > 50
""")
def groups_over_50(spark: SparkSession, d: str) -> DataFrame:
    grouped = t.events(spark, d).groupBy("user_id").agg(
        F.count("*").alias("n"), cents_mean(F.col("value")).alias("avg_value")
    )
    return grouped.filter(F.col("n") > 50)


# The pivoted columns, given so that Spark needs no pass to find them.
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "SELECT nation_id, "
    + ", ".join(f"CAST(sum(salary) FILTER (WHERE department = '{s}') AS DOUBLE) AS {s.lower()}" for s in SEGMENTS)
    + f" FROM {t.CUSTOMERS} GROUP BY nation_id"
)
def pivot_segment(spark: SparkSession, d: str) -> DataFrame:
    wide = t.customers(spark, d).groupBy("nation_id").pivot("department", SEGMENTS).agg(total(F.col("salary")))
    return wide.toDF("nation_id", *[s.lower() for s in SEGMENTS])


# --------------------------------------------------------------------------------- joins

CUSTOMER_SUMMARY_SQL = f"""
SELECT name, department, count(*) AS total_orders, CAST(sum(quantity) AS BIGINT) AS total_items,
  CAST(sum(revenue) AS DOUBLE) AS total_spent
FROM {t.CUSTOMERS} JOIN {t.ORDERS} USING (customer_id) JOIN
  (SELECT order_id, sum(quantity) AS quantity, sum(revenue) AS revenue FROM {t.LINES} GROUP BY order_id) tot
  USING (order_id)
GROUP BY name, department ORDER BY total_spent DESC
"""


@query(CUSTOMER_SUMMARY_SQL)
def customer_order_summary(spark: SparkSession, d: str) -> DataFrame:
    """Orders, items and spending per customer, biggest spender first.

    Lines are added up per order and orders per customer before customers are joined, so a
    customer or order with very many lines is one row by then.
    """
    people = t.customers(spark, d).select("customer_id", "name", "department")
    joined = people.join(t.customer_totals(spark, d), "customer_id")
    summary = joined.groupBy("name", "department").agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("total_items").alias("total_items"),
        cents_total(F.col("total_spent")).alias("total_spent"),
    )
    return summary.orderBy(F.desc("total_spent"))


@query("""
SELECT c_custkey, c_name, c_mktsegment FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def customers_without_orders(spark: SparkSession, d: str) -> DataFrame:
    """Customers who never placed an urgent order (every one placed some order)."""
    urgent = t.orders(spark, d).filter(F.col("priority") == "1-URGENT")
    left = t.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return joins.without_match(left, urgent.select(F.col("customer_id").alias("c_custkey")), ["c_custkey"])


@query("""
SELECT c_custkey, coalesce(n, 0) AS low_orders
FROM (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY o_custkey) o
RIGHT JOIN customer ON o_custkey = c_custkey
""")
def right_join(spark: SparkSession, d: str) -> DataFrame:
    low = t.orders(spark, d).filter(F.col("priority") == "5-LOW").groupBy("customer_id").agg(F.count("*").alias("n"))
    people = t.table(spark, d, "customer").select(F.col("c_custkey").alias("customer_id"))
    joined = low.join(people, "customer_id", "right")
    return joined.select(F.col("customer_id").alias("c_custkey"), F.coalesce("n", F.lit(0)).alias("low_orders"))


@query("""
SELECT coalesce(b.user_id, s.user_id) AS user_id, coalesce(b.day, s.day) AS day, bought, signed
FROM (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS bought FROM events
      WHERE event_type = 'purchase' GROUP BY ALL) b
FULL OUTER JOIN (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS signed FROM events
      WHERE event_type = 'signup' GROUP BY ALL) s
ON b.user_id = s.user_id AND b.day = s.day
""")
def full_outer_join(spark: SparkSession, d: str) -> DataFrame:
    def per_day(kind: str, name: str) -> DataFrame:
        rows = t.table(spark, d, "events").filter(F.col("event_type") == kind)
        return rows.groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.count("*").alias(name))

    return per_day("purchase", "bought").join(per_day("signup", "signed"), ["user_id", "day"], "outer")


@query("""
SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def expr_join(spark: SparkSession, d: str) -> DataFrame:
    suppliers, nation = t.table(spark, d, "supplier"), t.table(spark, d, "nation")
    joined = suppliers.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_suppkey", "s_name", "n_name")


@query(f"""
SELECT s_nationkey AS nation_id, count(*) AS n, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM {t.LINES} JOIN supplier ON supplier_id = s_suppkey GROUP BY s_nationkey
""")
def broadcast_join(spark: SparkSession, d: str) -> DataFrame:
    suppliers = t.table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("supplier_id"), F.col("s_nationkey").alias("nation_id")
    )
    joined = joins.dimension_join(t.lines(spark, d), suppliers, ["supplier_id"])
    return joined.groupBy("nation_id").agg(F.count("*").alias("n"), cents_total(F.col("revenue")).alias("revenue"))


@query(f"""
SELECT priority, flag, count(*) AS n, CAST(sum(revenue) AS DOUBLE) AS revenue
FROM {t.ORDERS} JOIN {t.LINES} USING (order_id) GROUP BY priority, flag
""")
def shuffle_join(spark: SparkSession, d: str) -> DataFrame:
    rows = t.lines(spark, d).groupBy("order_id", "flag").agg(
        F.count("*").alias("n"), F.sum("revenue").alias("revenue")
    )
    joined = joins.merge_join(t.orders(spark, d).select("order_id", "priority"), rows, ["order_id"])
    return joined.groupBy("priority", "flag").agg(F.sum("n").alias("n"), cents_total(F.col("revenue")).alias("revenue"))


@query(f"""
SELECT department, count(*) AS customers, CAST(sum(n) AS BIGINT) AS orders, CAST(sum(spent) AS DOUBLE) AS spent
FROM {t.CUSTOMERS} JOIN (SELECT customer_id, count(*) AS n, sum(price) AS spent
  FROM {t.ORDERS} GROUP BY customer_id) o USING (customer_id) GROUP BY department
""")
def copartitioned_join(spark: SparkSession, d: str) -> DataFrame:
    per_customer = t.orders(spark, d).groupBy("customer_id").agg(
        F.count("*").alias("n"), F.sum("price").alias("spent")
    )
    people = t.customers(spark, d).select("customer_id", "department")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    joined = joins.copartitioned_join(per_customer, people, "customer_id", n)
    return joined.groupBy("department").agg(
        F.count("*").alias("customers"), F.sum("n").alias("orders"), total(F.col("spent")).alias("spent")
    )


# ------------------------------------------------------------------- sort, limit, sample


@query(f"""
SELECT customer_id, name, CAST(total_spent AS DOUBLE) AS total_spent FROM
  (SELECT customer_id, sum(revenue) AS total_spent FROM {t.ORDERS} JOIN {t.LINES} USING (order_id)
   GROUP BY customer_id ORDER BY total_spent DESC, customer_id LIMIT 3) top
JOIN {t.CUSTOMERS} USING (customer_id)
""")
def top3_customers(spark: SparkSession, d: str) -> DataFrame:
    spent = t.customer_totals(spark, d).select("customer_id", "total_spent")
    best = spent.orderBy(F.desc("total_spent"), "customer_id").limit(3)
    people = t.customers(spark, d).select("customer_id", "name")
    named = people.join(F.broadcast(best), "customer_id")  # three rows
    return named.select("customer_id", "name", cents_value("total_spent").alias("total_spent"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def head_n(spark: SparkSession, d: str) -> DataFrame:
    return t.table(spark, d, "orders").select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(10)


@query("""
SELECT event_id, user_id, event_type FROM events WHERE substr(md5(CAST(event_id AS VARCHAR)), 1, 2) < '1a'
""")
def hash_sample(spark: SparkSession, d: str) -> DataFrame:
    """A tenth of the events, chosen by a hash so that every run takes the same rows."""
    rows = t.table(spark, d, "events").select("event_id", "user_id", "event_type")
    return rows.filter(F.substring(F.md5(F.col("event_id").cast("string").cast("binary")), 1, 2) < "1a")


@query(f"""
SELECT p_name AS product_name, CAST(sum(quantity) AS BIGINT) AS total_quantity
FROM {t.LINES} JOIN part ON product_id = p_partkey GROUP BY p_name
ORDER BY total_quantity DESC, product_name LIMIT 1
""")
def most_popular_product(spark: SparkSession, d: str) -> DataFrame:
    per_part = t.lines(spark, d).groupBy("product_id").agg(F.sum("quantity").alias("quantity"))
    part = t.table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), "p_name")
    by_name = per_part.join(part, "product_id").groupBy(F.col("p_name").alias("product_name"))
    totals = by_name.agg(F.sum("quantity").alias("total_quantity"))
    return totals.orderBy(F.desc("total_quantity"), "product_name").limit(1)


# ------------------------------------------------------------------------- set operations


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return t.table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()


# -------------------------------------------------------------------------------- SQL text


def _views(spark: SparkSession, d: str) -> None:
    t.customers(spark, d).createOrReplaceTempView("customers_view")
    t.orders(spark, d).createOrReplaceTempView("orders_view")


@query(f"""
SELECT name, department, count(order_id) AS order_count FROM {t.CUSTOMERS}
LEFT JOIN {t.ORDERS} USING (customer_id) GROUP BY name, department ORDER BY order_count DESC
""")
def sql_left_join_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of orders, zero included; orders are counted before the join."""
    _views(spark, d)
    return spark.sql("""
        WITH counted AS (SELECT customer_id, count(*) AS n FROM orders_view GROUP BY customer_id)
        SELECT name, department, sum(coalesce(n, 0)) AS order_count
        FROM customers_view LEFT JOIN counted USING (customer_id)
        GROUP BY name, department ORDER BY order_count DESC
    """)


@query(f"SELECT customer_id, count(*) AS order_count FROM {t.ORDERS} GROUP BY customer_id HAVING count(*) > 2")
def sql_repeat_customers(spark: SparkSession, d: str) -> DataFrame:
    _views(spark, d)
    return spark.sql(
        "SELECT customer_id, count(*) AS order_count FROM orders_view GROUP BY customer_id HAVING count(*) > 2"
    )


@query(f"""
SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, count(*) AS order_count,
  CAST(sum(price) AS DOUBLE) AS total_amount FROM {t.ORDERS} GROUP BY 1
""")
def sql_monthly_totals(spark: SparkSession, d: str) -> DataFrame:
    _views(spark, d)
    return spark.sql("""
        SELECT trunc(order_date, 'MM') AS month, count(*) AS order_count,
               cast(sum(price) AS double) AS total_amount
        FROM orders_view GROUP BY 1 ORDER BY 1
    """)


@query(f"SELECT customer_id, name FROM {t.CUSTOMERS} WHERE salary > 5000")
def sql_filter_view(spark: SparkSession, d: str) -> DataFrame:
    _views(spark, d)
    return spark.sql("SELECT customer_id, name FROM customers_view WHERE salary > 5000")
