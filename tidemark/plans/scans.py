"""Scans, sinks and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.functions import text, times
from tidemark.functions.numbers import money, ratio
from tidemark.functions.udfs import upper_batch
from tidemark.plans import tables as t
from tidemark.plans.registry import query
from tidemark.session import shared_folder
from tidemark.sources import files, sinks

# --------------------------------------------------------------------------------- scans


@query("""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
""")
def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    """Two of the three tests reach the scan as pushed filters; three columns are read."""
    day = F.col("o_orderdate")
    year = (day >= F.lit("1998-01-01").cast("timestamp_ntz")) & (day < F.lit("1999-01-01").cast("timestamp_ntz"))
    return t.table(spark, d, "orders").filter(year).select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS order_id, CAST(o_custkey AS INTEGER) AS customer_id,
  o_orderpriority AS product_name, 1 AS quantity, o_totalprice AS price,
  CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status FROM orders
""")
def scan_csv(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as CSV with a header and read back under the declared schema."""
    path = shared_folder(spark, "orders-csv")
    rows = t.orders(spark, d).select(
        "order_id", "customer_id", F.col("priority").alias("product_name"),
        F.lit(1).alias("quantity"), "price", "order_date", "status",
    )
    sinks.write_csv(rows, path)
    read = files.scan_csv(spark, path, schemas.declared("orders"))
    return read.withColumn("price", F.col("price").cast("double"))


_LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"]


def _lines_as_csv(spark: SparkSession, d: str) -> str:
    path = shared_folder(spark, "lines-csv")
    sinks.write_csv(t.table(spark, d, "lineitem").select(*_LINE_COLUMNS), path)
    return path


@query("""
SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_returnflag, CAST(l_quantity AS DOUBLE) AS l_quantity FROM lineitem
""")
def scan_csv_inferred(spark: SparkSession, d: str) -> DataFrame:
    """Lines written as CSV and read back with the types Spark finds in the text."""
    read = files.scan_csv_inferred(spark, _lines_as_csv(spark, d))
    return read.withColumns({c: F.col(c).cast("int") for c in ("l_orderkey", "l_linenumber")})


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_returnflag FROM lineitem
""")
def scan_csv_as_text(spark: SparkSession, d: str) -> DataFrame:
    """The same with every column as text."""
    return files.scan_csv_as_text(spark, _lines_as_csv(spark, d)).drop("l_quantity")


@query("SELECT event_id, ts, user_id, event_type FROM events")
def required_events(spark: SparkSession, d: str) -> DataFrame:
    """All events, with the requirement that four fields are there in the plan itself."""
    expected = StructType.fromDDL("event_id bigint not null, ts timestamp_ntz not null, user_id bigint not null, event_type string not null")
    events = t.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "event_type")
    return schemas.required(events, expected, F.col("event_id"))


@query("""
SELECT n_nationkey AS id, n_name AS name, n_regionkey AS region FROM nation
""")
def scan_json(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark, "nation-json")
    nation = t.table(spark, d, "nation")
    sinks.write_json(nation.toDF("id", "name", "region"), path)
    return files.scan_json(spark, path, "id int, name string, region int")


@query("""
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events
""")
def scan_json_props(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json("props", "k int")
    return t.table(spark, d, "events").select("event_id", parsed["k"].alias("k"))


# Each record as text. Decimals are strings, dates ISO text, as both engines print them.
@query("""
SELECT '{"order_id":' || o_orderkey || ',"price":"' || CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR)
  || '","order_date":"' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) || '","status":"' || o_orderstatus || '"}' AS json
FROM orders
""")
def export_json(spark: SparkSession, d: str) -> DataFrame:
    return sinks.as_json(t.orders(spark, d).select("order_id", "price", "order_date", "status"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_key, CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS seen,
  CAST(user_id AS INTEGER) AS user_id, event_type AS action, CAST(value AS DOUBLE) AS value FROM events
""")
def conform_events(spark: SparkSession, d: str) -> DataFrame:
    """Raw rows with text times brought to the declared live-data schema."""
    raw = t.table(spark, d, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "user_id",
        F.col("event_type").alias("action"),
        money("value").alias("value"),
        F.col("event_id").cast("string").alias("session_id"),
    )
    parsed = raw.withColumn("timestamp", F.try_to_timestamp("timestamp", F.lit("yyyy-MM-dd HH:mm:ss")))
    narrow = parsed.withColumn("user_id", F.col("user_id").cast("int"))
    typed = schemas.conform(narrow, schemas.declared("live_data"))
    return typed.select(
        F.col("session_id").alias("event_key"), times.plain("timestamp").alias("seen"),
        "user_id", "action", F.col("value").cast("double").alias("value"),
    )


# ------------------------------------------------------------------------ scalar functions


@query("""
SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low, length(p_name) AS n, trim('  ' || p_name || ' ') AS trimmed,
  split_part(p_name, ' ', 1) AS first_word, contains(p_name, 'ring') AS has_ring, p_brand || '/' || p_type AS joined
FROM part
""")
def string_functions(spark: SparkSession, d: str) -> DataFrame:
    name = F.col("p_name")
    return t.table(spark, d, "part").select(
        "p_partkey",
        F.upper(name).alias("up"),
        F.lower("p_brand").alias("low"),
        F.length(name).cast("bigint").alias("n"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.split(name, " ").getItem(0).alias("first_word"),
        name.contains("ring").alias("has_ring"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
    )


_TITLE = """array_to_string(list_transform(regexp_extract_all({0}, '(\\p{{L}}+|\\P{{L}}+)'),
  lambda x: CASE x[1] WHEN 'ß' THEN 'Ss' ELSE upper(x[1]) END || lower(x[2:])), '')"""


@query(f"""
SELECT p_partkey AS id, {_TITLE.format("trim(p_name)")} AS name, {_TITLE.format("trim(p_brand)")} AS brand FROM part
""")
def clean_names(spark: SparkSession, d: str) -> DataFrame:
    def clean(c: str):
        return text.title_case(text.strip(F.concat(F.lit(" \t"), F.upper(c), F.lit("\n"))))

    return t.table(spark, d, "part").select(
        F.col("p_partkey").alias("id"), clean("p_name").alias("name"), clean("p_brand").alias("brand")
    )


@query(f"SELECT doc_id, {_TITLE.format('text')} AS title FROM documents")
def title_case_texts(spark: SparkSession, d: str) -> DataFrame:
    """Title case over whole texts in several languages."""
    return t.table(spark, d, "documents").select("doc_id", text.title_case(F.col("text")).alias("title"))


@query("SELECT p_partkey AS id, lower(trim(p_name)) AS product, upper(trim(p_brand)) AS code FROM part")
def clean_codes(spark: SparkSession, d: str) -> DataFrame:
    def padded(c: str):
        return text.strip(F.concat(F.lit("\t "), F.col(c), F.lit(" ")))

    return t.table(spark, d, "part").select(
        F.col("p_partkey").alias("id"),
        F.lower(padded("p_name")).alias("product"),
        F.upper(padded("p_brand")).alias("code"),
    )


@query(r"""
SELECT doc_id, token, count(*) AS n,
  regexp_full_match(token, '[\p{L}\p{M}\p{Nd}_\.-]+@[\p{L}\p{M}\p{Nd}_\.-]+\.[\p{L}\p{M}\p{Nd}_]+') AS is_email
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS token FROM documents) w
WHERE contains(token, '@') GROUP BY doc_id, token
""")
def validate_email(spark: SparkSession, d: str) -> DataFrame:
    tokens = t.table(spark, d, "documents").select("doc_id", text.words(F.col("text")).alias("token"))
    found = tokens.filter(F.col("token").contains("@")).groupBy("doc_id", "token").agg(F.count("*").alias("n"))
    return found.withColumn("is_email", text.is_email(F.col("token")))


@query("""
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, o_orderdate AS moment, CAST(NULL AS DATE) AS bad
FROM orders
""")
def parse_dates(spark: SparkSession, d: str) -> DataFrame:
    """Text to date and timestamp; text that is no date becomes null instead of an error."""
    raw = t.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("raw"))
    return raw.select(
        "o_orderkey",
        F.to_date("raw", "yyyy-MM-dd").alias("day"),
        times.plain(F.to_timestamp("raw", "yyyy-MM-dd")).alias("moment"),
        F.try_to_timestamp(F.concat(F.lit("x"), "raw"), F.lit("yyyy-MM-dd")).cast("date").alias("bad"),
    )


@query("""
SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(quarter(ts) AS INTEGER) AS quarter,
  CAST(month(ts) AS INTEGER) AS month, CAST(hour(ts) AS INTEGER) AS hour, true AS past FROM events
""")
def date_parts(spark: SparkSession, d: str) -> DataFrame:
    return t.table(spark, d, "events").select(
        "event_id",
        F.year("ts").alias("year"), F.quarter("ts").alias("quarter"),
        F.month("ts").alias("month"), F.hour("ts").alias("hour"),
        (F.col("ts").cast("date") < F.current_date()).alias("past"),
    )


@query("""
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown,
  date_trunc('second', ts) AS moment FROM events
""")
def epoch_functions(spark: SparkSession, d: str) -> DataFrame:
    seconds = F.unix_timestamp("ts")
    return t.events(spark, d).select(
        "event_id",
        seconds.alias("seconds"),
        F.from_unixtime(seconds).alias("shown"),
        times.plain(seconds.cast("timestamp")).alias("moment"),
    )


@query("""
SELECT event_id, ts + INTERVAL 2 MINUTE AS later, ts - INTERVAL 2 MINUTE AS earlier FROM events
""")
def interval_shift(spark: SparkSession, d: str) -> DataFrame:
    two = F.expr("INTERVAL 2 MINUTES")
    return t.table(spark, d, "events").select(
        "event_id", (F.col("ts") + two).alias("later"), (F.col("ts") - two).alias("earlier")
    )


@query("""
SELECT event_id, CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) * 10 > 300 THEN 'LATE' ELSE 'ON_TIME' END
  AS arrival_status FROM events
""")
def late_status(spark: SparkSession, d: str) -> DataFrame:
    """A row counts as seen ``k`` times ten seconds after it happened; five minutes are allowed."""
    delay = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), text.json_number(F.col("props"), "k") * 10)
    rows = t.events(spark, d).withColumn("seen_at", F.col("ts") + delay)
    status = times.arrival_status(F.col("ts"), F.col("seen_at"), 300)
    return rows.select("event_id", status.alias("arrival_status"))


@query("""
SELECT event_id, CAST(s // 120 * 120 AS BIGINT) AS time_bucket, CAST(s // 120 * 120 % 300 AS BIGINT) AS five_min_offset,
  CAST(s // 120 * 120 % 600 AS BIGINT) AS ten_min_offset
FROM (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events) e
""")
def time_buckets(spark: SparkSession, d: str) -> DataFrame:
    start = times.epoch_bucket(F.unix_timestamp("ts"), 120)
    rows = t.events(spark, d).select("event_id", start.alias("time_bucket"))
    return rows.withColumns({
        "five_min_offset": times.offset_in(F.col("time_bucket"), 300),
        "ten_min_offset": times.offset_in(F.col("time_bucket"), 600),
    })


@query("""
SELECT c_custkey, c_acctbal + 1 AS plus, c_acctbal - 1 AS minus, c_acctbal * 2 AS twice, c_acctbal / 4 AS quarter,
  c_custkey % 7 AS rest, CAST(round(CAST(c_acctbal AS DECIMAL(10,2)), 1) AS DOUBLE) AS rounded,
  CAST(c_custkey AS INTEGER) AS as_int, CAST(c_custkey AS VARCHAR) AS as_text, c_acctbal > 0 AS positive,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal / (c_custkey % 7) END AS safe_ratio
FROM customer
""")
def math_functions(spark: SparkSession, d: str) -> DataFrame:
    balance, key = F.col("c_acctbal"), F.col("c_custkey")
    return t.table(spark, d, "customer").select(
        "c_custkey",
        (balance + 1).alias("plus"), (balance - 1).alias("minus"),
        (balance * 2).alias("twice"), (balance / 4).alias("quarter"),
        (key % 7).alias("rest"),
        F.round(money(balance), 1).cast("double").alias("rounded"),
        key.cast("int").alias("as_int"), key.cast("string").alias("as_text"),
        (balance > 0).alias("positive"),
        ratio(balance, key % 7).alias("safe_ratio"),
    )


@query("""
SELECT event_id, coalesce(kind, 'Unknown') AS kind, coalesce(amount, 0) AS amount, kind IS NULL AS was_null
FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS kind,
  CASE WHEN value > 10 THEN value END AS amount, user_id FROM events) e
WHERE kind IS NOT NULL OR amount IS NOT NULL
""")
def null_handling(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("kind"),
        F.when(F.col("value") > 10, F.col("value")).alias("amount"),
    )
    known = rows.na.drop(how="all", subset=["kind", "amount"]).withColumn("was_null", F.isnull("kind"))
    return known.na.fill("Unknown", ["kind"]).na.fill(0.0, ["amount"])


@query("SELECT p_partkey, upper(p_name) AS name_upper FROM part")
def udf_upper(spark: SparkSession, d: str) -> DataFrame:
    return t.table(spark, d, "part").select("p_partkey", upper_batch("p_name").alias("name_upper"))


# ------------------------------------------------------------------------- nested records


def nested_orders(spark: SparkSession, d: str) -> DataFrame:
    """Each order line as a nested record of one order with two items (goods and tax)."""
    rows = t.table(spark, d, "lineitem")
    item = F.struct(
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("price"),
    )
    tax = F.struct(
        F.lit("tax").alias("product_id"),
        F.col("l_linenumber").alias("quantity"),
        money("l_tax").alias("price"),
    )
    order = F.struct(
        F.col("l_orderkey").cast("int").alias("order_id"),
        F.array(item, tax).alias("items"),
        times.instant("l_shipdate").alias("order_date"),
        money("l_extendedprice", 12).alias("total"),
    )
    preferences = F.struct(
        (F.col("l_returnflag") == "R").alias("notifications"),
        F.col("l_linestatus").alias("theme"),
        F.lit(None).cast("string").alias("language"),
    )
    user = F.struct(
        F.col("l_suppkey").cast("int").alias("user_id"),
        F.concat(F.lit("user "), F.col("l_suppkey")).alias("name"),
        F.concat(F.lit("u"), F.col("l_suppkey"), F.when(F.col("l_discount") > 0.05, "@shop.com").otherwise("@shop")).alias("email"),
        preferences.alias("preferences"),
    )
    return rows.select(
        F.col("l_orderkey").cast("int").alias("id"),
        user.alias("user_info"),
        F.array(order).alias("orders"),
        F.create_map(F.lit("flag"), "l_returnflag").alias("metadata"),
    )


@query("""
SELECT l_orderkey AS order_id, product_id, theme, flag, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(price) AS DOUBLE) AS price
FROM (SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS product_id, l_linestatus AS theme,
        l_returnflag AS flag, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(10,2)) AS price FROM lineitem
      UNION ALL SELECT CAST(l_orderkey AS INTEGER), 'tax', l_linestatus, l_returnflag, l_linenumber, CAST(l_tax AS DECIMAL(10,2)) FROM lineitem) i
GROUP BY ALL
""")
def nested_orders_flatten(spark: SparkSession, d: str) -> DataFrame:
    per_order = nested_orders(spark, d).select(
        F.explode("orders").alias("o"),
        F.col("user_info.preferences").getField("theme").alias("theme"),
        F.element_at("metadata", F.lit("flag")).alias("flag"),
    )
    items = per_order.select(F.col("o.order_id").alias("order_id"), "theme", "flag", F.explode("o.items").alias("i"))
    grouped = items.groupBy("order_id", F.col("i.product_id").alias("product_id"), "theme", "flag")
    return grouped.agg(F.sum("i.quantity").alias("quantity"), F.sum("i.price").cast("double").alias("price"))


@query("""
SELECT event_type, count(*) AS n, count(*) FILTER (WHERE epoch(ts) < epoch(now())) AS n_seen_later, CAST(max(floor(epoch(ts))) - min(floor(epoch(ts))) AS BIGINT) AS spread
FROM events GROUP BY event_type
""")
def processing_delays(spark: SparkSession, d: str) -> DataFrame:
    """How long ago events of each type happened: all before now, and the delays apart by as much as the times themselves."""
    rows = t.table(spark, d, "events").select("event_type", times.processing_delay(times.instant("ts")).alias("delay"))
    return rows.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_if(F.col("delay") > 0).alias("n_seen_later"), (F.max("delay") - F.min("delay")).alias("spread")
    )
