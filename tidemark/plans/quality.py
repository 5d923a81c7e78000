"""Validation and cleaning over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import money
from tidemark.functions.text import json_number
from tidemark.operators import quality as q
from tidemark.plans import tables as t
from tidemark.plans.registry import query
from tidemark.plans.scans import nested_orders


def _found(validated: DataFrame) -> Column:
    return F.array_join(q.ERRORS, "; ").alias("errors")


def sql_errors(*checks: tuple[str, str]) -> str:
    """SQL for the error text: (condition that fails, message) per check, in order."""
    cases = ", ".join(f"CASE {test} END" for test in _by_field(checks))
    return f"array_to_string(list_filter([{cases}], lambda x: x IS NOT NULL), '; ')"


def _by_field(checks: tuple[tuple[str, str, str], ...]) -> list[str]:
    fields: dict[str, list[str]] = {}
    for name, fails, message in checks:
        text = f"Field ''{name}'': {message}"
        fields.setdefault(name, []).append(f"WHEN {fails} THEN '{text}'")
    return [" ".join(cases) for cases in fields.values()]


DEPARTMENT_SQL = """CASE c_mktsegment WHEN 'BUILDING' THEN 'Engineering' WHEN 'AUTOMOBILE' THEN 'Sales'
  WHEN 'MACHINERY' THEN 'Marketing' WHEN 'HOUSEHOLD' THEN 'HR' ELSE 'finance' END"""
PEOPLE_SQL = f"""(SELECT c_custkey AS customer_id, '  ' || lower(c_name) || ' ' AS name,
  CASE WHEN c_custkey % 10 > 0 THEN CAST(c_custkey % 108 + 15 AS INTEGER) END AS age, n_name AS city,
  CAST(c_acctbal AS DECIMAL(10,2)) AS salary, {DEPARTMENT_SQL} AS department
  FROM customer JOIN nation ON c_nationkey = n_nationkey) people"""
PEOPLE_ERRORS = sql_errors(
    ("customer_id", "customer_id <= 0", "Input should be greater than 0"),
    ("age", "age < 18", "Input should be greater than or equal to 18"),
    ("age", "age > 120", "Input should be less than or equal to 120"),
    ("salary", "salary < 0", "Input should be greater than or equal to 0"),
    (
        "department",
        "department = 'finance'",
        "Input should be ''Engineering'', ''Sales'', ''Marketing'', ''HR'' or ''Finance''",
    ),
)


def people(spark: SparkSession, d: str) -> DataFrame:
    """Customers as employee records, with ages out of range, negative salaries and one
    department in the wrong case."""
    segments = {"BUILDING": "Engineering", "AUTOMOBILE": "Sales", "MACHINERY": "Marketing", "HOUSEHOLD": "HR"}
    department = F.lit("finance")
    for segment, name in segments.items():
        department = F.when(F.col("c_mktsegment") == segment, name).otherwise(department)
    key = F.col("c_custkey")
    nation = t.table(spark, d, "nation").select("n_nationkey", "n_name")
    rows = t.table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select(
        key.alias("customer_id"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("name"),
        F.when(key % 10 > 0, (key % 108 + 15).cast("int")).alias("age"),
        F.col("n_name").alias("city"),
        money("c_acctbal").alias("salary"),
        department.alias("department"),
    )


@query(f"SELECT customer_id, {PEOPLE_ERRORS} AS errors FROM {PEOPLE_SQL}")
def validate_customers(spark: SparkSession, d: str) -> DataFrame:
    validated = q.validate(people(spark, d), q.customer_rules())
    return validated.select("customer_id", _found(validated))


PURCHASES_SQL = """(SELECT l_orderkey AS order_id, l_suppkey AS customer_id, l_linenumber AS line,
  CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS price,
  CASE l_returnflag WHEN 'A' THEN 'completed' WHEN 'R' THEN 'returned' END AS status FROM lineitem) purchases"""
# Half-even rounding in whole numbers: four decimals to two.
ROUNDED_SQL = """(CAST(price * 10000 AS BIGINT) // 100 + CASE
  WHEN CAST(price * 10000 AS BIGINT) % 100 > 50 THEN 1 WHEN CAST(price * 10000 AS BIGINT) % 100 < 50 THEN 0
  ELSE CAST(price * 10000 AS BIGINT) // 100 % 2 END)"""
PURCHASE_ERRORS = sql_errors(
    ("order_id", "order_id <= 0", "Input should be greater than 0"),
    ("customer_id", "customer_id <= 0", "Input should be greater than 0"),
    ("price", "price <= 0", "Input should be greater than 0"),
    (
        "status",
        "status = 'returned'",
        "Input should be ''pending'', ''shipped'', ''completed'' or ''cancelled''",
    ),
)


def purchases(spark: SparkSession, d: str) -> DataFrame:
    """Order lines as order records; some prices are 0, some statuses unknown or missing."""
    price = (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)")
    status = F.when(F.col("l_returnflag") == "A", "completed").when(F.col("l_returnflag") == "R", "returned")
    return t.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("customer_id"),
        F.lit("  order item ").alias("product_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        price.alias("price"),
        status.alias("status"),
        F.col("l_linenumber").alias("line"),
    )


@query(f"""
SELECT order_id, line, CASE WHEN errors = '' THEN CAST(cents AS DOUBLE) / 100 END AS price,
  CASE WHEN errors = '' AND cents * quantity > 1000000 THEN 'over the maximum' ELSE errors END AS errors,
  coalesce(status, 'pending') AS status
FROM (SELECT *, {PURCHASE_ERRORS} AS errors, {ROUNDED_SQL} AS cents FROM {PURCHASES_SQL}) v
""")
def validate_orders(spark: SparkSession, d: str) -> DataFrame:
    validated = q.validate(purchases(spark, d), q.order_rules())
    text = F.array_join(q.ERRORS, "; ")
    over = text.contains("exceeds maximum allowed")
    no_field_error = (F.size(q.ERRORS) == 0) | over
    return validated.select(
        "order_id", "line",
        F.when(no_field_error, F.col("price").cast("double")).alias("price"),
        F.when(over, "over the maximum").otherwise(text).alias("errors"),
        "status",
    )


ACTION_TEXT = "Input should be ''view'', ''click'', ''add_to_cart'', ''purchase'' or ''remove_from_cart''"
ACTIVITY_SQL = """(SELECT event_id, ts, user_id, event_type AS action, '  K' || CAST(json_extract(props, '$.k') AS VARCHAR) || ' ' AS product,
  CAST(value AS DECIMAL(18,2)) - 5 AS value FROM events) act"""
ACTIVITY_ERRORS = sql_errors(
    ("user_id", "user_id <= 0", "Input should be greater than 0"),
    ("action", "action IN ('signup', 'error')", ACTION_TEXT),
    ("value", "value < 0", "Input should be greater than or equal to 0"),
)


@query(f"""
SELECT event_id, {ACTIVITY_ERRORS} AS errors,
  CASE WHEN {ACTIVITY_ERRORS} = '' THEN lower(trim(product)) ELSE product END AS product FROM {ACTIVITY_SQL}
""")
def validate_activity(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "events").select(
        "event_id", F.col("ts").alias("timestamp"), "user_id", F.col("event_type").alias("action"),
        F.concat(F.lit("  K"), json_number(F.col("props"), "k"), F.lit(" ")).alias("product"),
        (t.value() - 5).alias("value"),
    )
    validated = q.validate(rows, q.activity_rules())
    return validated.select("event_id", _found(validated), "product")


TRANSACTION_ERRORS = sql_errors(
    ("user_id", "user_id <= 0", "Input should be greater than 0"),
    ("product_id", "product_id = ''", "String should have at least 1 character"),
    ("amount", "amount <= 0", "Input should be greater than 0"),
)


@query(f"""
SELECT event_id, errors, CASE WHEN errors = '' THEN upper(trim(product_id)) ELSE product_id END AS product_id,
  CASE WHEN errors = '' THEN upper(city[1]) || lower(city[2:]) ELSE city END AS city
FROM (SELECT *, {TRANSACTION_ERRORS} AS errors FROM (SELECT event_id, user_id, event_type AS city,
  CASE WHEN event_type = 'error' THEN '' ELSE ' k' || CAST(json_extract(props, '$.k') AS VARCHAR) END AS product_id,
  CAST(value AS DECIMAL(18,2)) - 1 AS amount FROM events) r) v
""")
def validate_transactions(spark: SparkSession, d: str) -> DataFrame:
    product = F.concat(F.lit(" k"), json_number(F.col("props"), "k"))
    rows = t.table(spark, d, "events").select(
        "event_id", F.col("ts").alias("event_time"), "user_id",
        F.when(F.col("event_type") == "error", "").otherwise(product).alias("product_id"),
        (t.value() - 1).alias("amount"),
        F.col("event_type").alias("city"),
    )
    validated = q.validate(rows, q.transaction_rules())
    return validated.select("event_id", _found(validated), "product_id", "city")


LIVE_ERRORS = sql_errors(
    ("user_id", "user_id <= 0", "Input should be greater than 0"),
    ("action", "action IN ('signup', 'error')", ACTION_TEXT),
    ("session_id", "NOT starts_with(session_id, 'session_')", 'Value error, Session ID must start with "session_"'),
)


@query(f"""
SELECT event_id, {LIVE_ERRORS} AS errors FROM (SELECT event_id, user_id, event_type AS action,
  CASE WHEN user_id % 5 = 0 THEN 'visit_' ELSE 'session_' END || user_id AS session_id FROM events) r
""")
def validate_live(spark: SparkSession, d: str) -> DataFrame:
    prefix = F.when(F.col("user_id") % 5 == 0, "visit_").otherwise("session_")
    rows = t.table(spark, d, "events").select(
        "event_id", F.col("ts").alias("timestamp"), "user_id", F.col("event_type").alias("action"),
        t.value().alias("value"), F.concat(prefix, F.col("user_id")).alias("session_id"),
    )
    validated = q.validate(rows, q.live_rules())
    return validated.select("event_id", _found(validated))


# Each nested line is broken in its own way, some in several: by its line number and quantity.
NESTED_ERRORS = sql_errors(
    ("id", "l_orderkey <= 0", "Input should be greater than 0"),
    ("user_info.user_id", "l_linenumber = 5 OR l_suppkey <= 0", "Input should be greater than 0"),
    ("user_info.name", "l_linenumber = 4", "Field required"),
    ("user_info.email", "l_discount <= 0.05", "String should match the e-mail pattern"),
    ("orders.0.order_id", "l_orderkey <= 0", "Input should be greater than 0"),
    ("orders.0.items", "l_linenumber = 3", "List should have at least 1 item"),
    ("orders.0.items.0.product_id", "l_linenumber = 2", "String should have at least 1 character"),
    ("orders.0.items.0.quantity", "l_linenumber <> 3 AND l_quantity > 40", "Field required"),
    ("orders.0.items.1.price", "l_linenumber <> 3 AND l_tax <= 0", "Input should be greater than 0"),
    ("orders.0.order_date", "l_linenumber = 6", "Field required"),
    ("orders.0.total", "l_linenumber = 1", "Field required"),
)


def _broken(records: DataFrame) -> DataFrame:
    """Records with faults at every depth; the second item of an order tells its line number."""
    line, quantity = F.col("orders")[0]["items"][1]["quantity"], F.col("orders")[0]["items"][0]["quantity"]
    user = F.col("user_info")
    user = user.withField("user_id", F.when(line == 5, 0).otherwise(user["user_id"]))
    user = user.withField("name", F.when(line != 4, user["name"]))

    def item(x: Column, i: Column) -> Column:
        return x.withField("product_id", F.when((line == 2) & (i == 0), "").otherwise(x["product_id"])).withField(
            "quantity", F.when((i != 0) | (quantity <= 40), x["quantity"])
        )

    def order(x: Column) -> Column:
        kept = F.filter(x["items"], lambda _: line != 3)
        return x.withField("items", F.transform(kept, item)).withField(
            "order_date", F.when(line != 6, x["order_date"])
        ).withField("total", F.when(line != 1, x["total"]))

    return records.select("id", user.alias("user_info"), F.transform("orders", order).alias("orders"), "metadata")


@query(f"SELECT id, errors, count(*) AS n FROM (SELECT l_orderkey AS id, {NESTED_ERRORS} AS errors FROM lineitem) v GROUP BY id, errors")
def validate_nested(spark: SparkSession, d: str) -> DataFrame:
    validated = q.validate(_broken(nested_orders(spark, d)), q.nested_rules())
    found = validated.select(F.col("id").cast("bigint").alias("id"), _found(validated))
    return found.groupBy("id", "errors").agg(F.count("*").alias("n"))


@query(f"""
SELECT count(*) AS total_records, count(*) FILTER (WHERE errors = '') AS valid_count,
  count(*) FILTER (WHERE errors <> '') AS invalid_count,
  CAST(count(*) FILTER (WHERE errors = '') AS DOUBLE) / count(*) AS validation_rate
FROM (SELECT {PEOPLE_ERRORS} AS errors FROM {PEOPLE_SQL}) v
""")
def validation_summary(spark: SparkSession, d: str) -> DataFrame:
    return q.summary(q.validate(people(spark, d), q.customer_rules()))


@query(f"""
SELECT error, count(*) AS n FROM (SELECT unnest(string_split(errors, '; ')) AS error FROM
  (SELECT {PEOPLE_ERRORS} AS errors FROM {PEOPLE_SQL}) v WHERE errors <> '') e GROUP BY error
""")
def validation_error_report(spark: SparkSession, d: str) -> DataFrame:
    return q.error_report(q.validate(people(spark, d), q.customer_rules()))


@query(f"""
SELECT customer_id, errors FROM (SELECT customer_id, {PEOPLE_ERRORS} AS errors FROM {PEOPLE_SQL}) v
WHERE errors <> '' ORDER BY customer_id LIMIT 10
""")
def first_invalid_rows(spark: SparkSession, d: str) -> DataFrame:
    validated = q.first_rejected(q.validate(people(spark, d), q.customer_rules()), ["customer_id"], 10)
    return validated.select("customer_id", _found(validated))


@query(f"""
SELECT customer_id, name, errors FROM (SELECT customer_id, name, {PEOPLE_ERRORS} AS errors FROM {PEOPLE_SQL}) v
WHERE errors <> ''
""")
def quarantine_rows(spark: SparkSession, d: str) -> DataFrame:
    bad = q.rejected(q.validate(people(spark, d), q.customer_rules()))
    return bad.select("customer_id", "name", _found(bad))


@query(f"""
SELECT customer_id, upper(trim(name)[1]) || lower(trim(name)[2:]) AS name, department
FROM (SELECT *, {PEOPLE_ERRORS} AS errors FROM {PEOPLE_SQL}) v WHERE errors = ''
""")
def accepted_rows(spark: SparkSession, d: str) -> DataFrame:
    good = q.accepted(q.validate(people(spark, d), q.customer_rules()))
    return good.select("customer_id", "name", "department")


@query(f"""
SELECT customer_id, upper(trim(name)[1]) || lower(trim(name)[2:]) AS name, department
FROM (SELECT *, {PEOPLE_ERRORS} AS errors FROM {PEOPLE_SQL}) v WHERE errors = ''
""")
def strict_customers(spark: SparkSession, d: str) -> DataFrame:
    """A batch that must be valid as a whole: what cleaning lets through is held against the rules again, and any bad row stops the job."""
    rules = q.customer_rules()
    cleaned = q.accepted(q.validate(people(spark, d), rules))
    return q.require_valid(q.validate(cleaned, rules), ["customer_id"]).select("customer_id", "name", "department")


@query(f"""
SELECT customer_id, upper(trim(name)[1]) || lower(trim(name)[2:]) AS name, coalesce(age, 30) AS age,
  upper(city[1]) || lower(city[2:]) AS city, CAST(coalesce(salary, 50000) AS DOUBLE) AS salary, department
FROM (SELECT *, {PEOPLE_ERRORS} AS errors FROM {PEOPLE_SQL}) v WHERE errors = ''
""")
def clean_customers(spark: SparkSession, d: str) -> DataFrame:
    """Fill missing ages and salaries, clean names and cities, keep the valid records."""
    defaults = {"age": q.DEFAULT_AGE, "salary": q.DEFAULT_SALARY}
    filled = people(spark, d).na.fill(defaults)
    good = q.accepted(q.validate(filled, q.customer_rules()))
    return good.withColumn("salary", F.col("salary").cast("double"))
