"""Layout of tables: reports, ranges, directories, buckets."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import cents_mean, cents_ratio, cents_total, summable, total, whole_cents
from tidemark.operators import layout
from tidemark.plans import tables as t
from tidemark.plans.registry import query
from tidemark.session import partitions_for, shared_folder, written
from tidemark.sources import files, sinks


@query("SELECT count(*) AS total_records, TRUE AS is_consistent FROM lineitem")
def partition_report(spark: SparkSession, d: str) -> DataFrame:
    """The scan's own partitions: whatever their number, they hold all rows, and their figures agree."""
    report = layout.partition_report(t.lines(spark, d))
    average = F.col("total_records") / F.col("num_partitions")
    agree = (F.col("min_partition_size") <= average) & (F.col("max_partition_size") >= average) & (F.col("avg_partition_size") == average)
    return report.select("total_records", agree.alias("is_consistent"))


@query("""
SELECT layout, n AS total_records, s AS key_sum, TRUE AS holds FROM (SELECT count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS s FROM orders) o,
  (VALUES ('round robin'), ('hash'), ('hash, given number'), ('fewer')) v(layout)
""")
def repartitioned(spark: SparkSession, d: str) -> DataFrame:
    """All orders laid out in four ways, with what each promises: even parts, a key in one part, a bound on the number of parts."""
    orders = t.orders(spark, d).select("customer_id")
    sources = layout.partition_sizes(orders).agg(F.count("*")).scalar()

    def report(name: str, laid: DataFrame, holds: Column) -> DataFrame:
        part = laid.select("customer_id", F.spark_partition_id().alias("part"))
        cells = part.groupBy("part", "customer_id").agg(F.count("*").alias("n"))
        totals = [F.sum("n").alias("n"), F.count("*").alias("cells"), F.grouping("part").alias("is_key")]
        each = cells.groupingSets([["part"], ["customer_id"]], "part", "customer_id").agg(*totals)
        part_rows, key = F.when(F.col("is_key") == 0, F.col("n")), F.col("is_key") == 1
        figures = each.agg(
            F.sum(part_rows).alias("total_records"),
            F.sum(F.when(key, F.col("n") * F.col("customer_id"))).alias("key_sum"),
            F.count(part_rows).alias("filled"), F.max(part_rows).alias("most"), F.min(part_rows).alias("least"),
            F.max(F.when(key, F.col("cells"))).alias("parts_of_a_key"),
        )
        return figures.select(F.lit(name).alias("layout"), "total_records", "key_sum", holds.alias("holds"))

    # Each part of the source is dealt out evenly by itself.
    even = (F.col("most") - F.when(F.col("filled") == 6, F.col("least")).otherwise(0)) <= sources
    together = F.col("parts_of_a_key") == 1
    reports = [
        report("round robin", layout.round_robin(orders, 6), even),
        report("hash", layout.by_hash(orders, ["customer_id"]), together),
        report("hash, given number", layout.by_hash(orders, ["customer_id"], 5), together & (F.col("filled") <= 5)),
        report("fewer", layout.fewer(orders, 2), F.col("filled") <= 2),
    ]
    return reduce(DataFrame.unionByName, reports)


@query("""
SELECT mode, times * n AS n_rows, times * s AS balance FROM (SELECT count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(10,2))) AS DOUBLE) AS s FROM customer) c,
  (VALUES ('error', 1), ('append', 2), ('ignore', 2), ('overwrite', 1)) v(mode, times)
""")
def save_modes(spark: SparkSession, d: str) -> DataFrame:
    """The customers stored by one mode after the other on the same folder, and what the folder holds then."""
    path = shared_folder(spark, "customers")
    people = t.customers(spark, d).select("customer_id", "salary")
    reports = []
    for mode in ("error", "append", "ignore", "overwrite"):
        sinks.write_parquet(people, path, mode)
        held = files.scan_parquet(spark, path).agg(F.lit(mode).alias("mode"), F.count("*").alias("n_rows"), cents_total(whole_cents("salary")).alias("balance"))
        reports.append(written(held, f"held-{mode}"))
    return reduce(DataFrame.unionByName, reports)


@query("""
SELECT TRUE AS all_are_orders, TRUE AS at_most_three, TRUE AS no_partition_missing, count(*) AS n_orders FROM orders
""")
def partition_heads(spark: SparkSession, d: str) -> DataFrame:
    """The first three orders of every partition of the table, held against the table itself."""
    orders = t.orders(spark, d).select("order_id", "status")
    heads = layout.partition_heads(orders, 3)
    known = heads.join(orders.withColumnRenamed("status", "known"), "order_id", "left")
    each = known.groupBy("partition").agg(F.count("*").alias("n"), F.bool_and(F.col("status").eqNullSafe(F.col("known"))).alias("same"))
    sizes = layout.partition_sizes(orders)
    joined = sizes.join(each, "partition", "left")
    return joined.agg(
        F.bool_and(F.coalesce("same", F.lit(True))).alias("all_are_orders"),
        F.bool_and(F.coalesce("n", F.lit(0)) <= 3).alias("at_most_three"),
        F.bool_and(F.coalesce("n", F.lit(0)) == F.least(F.col("rows"), F.lit(3))).alias("no_partition_missing"),
        F.sum("rows").alias("n_orders"),
    )


@query("""
WITH r AS (SELECT CAST(min(l_shipdate) AS DATE) AS low, CAST(max(l_shipdate) AS DATE) - CAST(min(l_shipdate) AS DATE) + 1 AS days FROM lineitem),
l AS (SELECT CAST(l_shipdate AS DATE) AS day,
  CASE WHEN l_shipdate IS NULL THEN 0 ELSE 1 + (CAST(l_shipdate AS DATE) - low >= days // 4)::INTEGER
    + (CAST(l_shipdate AS DATE) - low >= days * 2 // 4)::INTEGER + (CAST(l_shipdate AS DATE) - low >= days * 3 // 4)::INTEGER END AS part
  FROM lineitem, r)
SELECT part, count(*) AS n, min(day) AS first_day, max(day) AS last_day FROM l GROUP BY part
""")
def union_quarters(spark: SparkSession, d: str) -> DataFrame:
    """The whole table as four date ranges of equal length, each its own pushed-down scan, put
    together again; rows without a date are part 0."""
    rows = t.table(spark, d, "lineitem").select("l_shipdate")
    first, last = rows.agg(F.min("l_shipdate").cast("date"), F.max("l_shipdate").cast("date")).first()
    parts = [rows.filter(F.col("l_shipdate").isNull()).withColumn("part", F.lit(0))]
    if first:
        days = (last - first).days + 1
        starts = [first + timedelta(days=days * i // 4) for i in range(5)]
        for i, (start, end) in enumerate(zip(starts, starts[1:]), start=1):
            low, high = (F.lit(day).cast("timestamp_ntz") for day in (start, end))
            inside = (F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high)
            parts.append(rows.filter(inside).withColumn("part", F.lit(i)))
    day = F.col("l_shipdate").cast("date")
    return reduce(DataFrame.unionByName, parts).groupBy("part").agg(
        F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day")
    )


@query(f"""
SELECT {t.sql_mean('price')} AS avg_price, count(*) AS n FROM {t.LINES}
WHERE sale_date >= DATE '1998-06-01' AND sale_date <= DATE '1998-08-31'
""")
def range_query_avg(spark: SparkSession, d: str) -> DataFrame:
    """The date test is on the stored column, so that it is pushed into the scan."""
    low, high = (F.lit(x).cast("timestamp_ntz") for x in (date(1998, 6, 1), date(1998, 9, 1)))
    rows = t.table(spark, d, "lineitem").filter((F.col("l_shipdate") >= low) & (F.col("l_shipdate") < high))
    price = summable(whole_cents("l_extendedprice"))
    return rows.agg(cents_mean(price).alias("avg_price"), F.count("*").alias("n"))


@query("""
SELECT event_id, event_type, volume FROM events JOIN (SELECT event_type,
  CASE WHEN n >= 0.201 * tot THEN 'high' WHEN n >= 0.199 * tot THEN 'medium' ELSE 'low' END AS volume
  FROM (SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS tot FROM events GROUP BY event_type) c) v
USING (event_type)
""")
def volume_aware_layout(spark: SparkSession, d: str) -> DataFrame:
    rows = t.table(spark, d, "events").select("event_id", "event_type", "user_id")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = layout.volume_aware(rows, "event_type", F.col("user_id"), high=0.201, medium=0.199, n=n)
    return laid.select("event_id", "event_type", "volume")


@query("""
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS n, min(CAST(l_shipdate AS DATE)) AS first_day, max(CAST(l_shipdate AS DATE)) AS last_day
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1
""")
def range_layout(spark: SparkSession, d: str) -> DataFrame:
    """All lines laid out by ranges of days, then read year by year: each scan skips the files and row groups of other years."""
    path = shared_folder(spark, "lines-by-day")
    rows = t.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_orderkey")
    layout.write_ranges(rows, ["day"], partitions_for(rows), path)
    laid = files.scan_parquet(spark, path)
    first, last = laid.agg(F.year(F.min("day")), F.year(F.max("day"))).first()
    years = range(first, last + 1) if first else [1970]
    year = lambda y: laid.filter((F.col("day") >= F.lit(date(y, 1, 1))) & (F.col("day") < F.lit(date(y + 1, 1, 1))))
    each = [year(y).agg(F.lit(y).alias("year"), F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day")) for y in years]
    return reduce(DataFrame.unionByName, each).filter("n > 0")


@query(f"""
SELECT region, count(*) AS transaction_count, CAST(sum(revenue) AS DOUBLE) AS total_sales
FROM {t.SALES} WHERE region IN ('ASIA', 'EUROPE') GROUP BY region
""")
def partitioned_scan(spark: SparkSession, d: str) -> DataFrame:
    """Sales of each supplier written by region; the reader then opens the directories of two regions only."""
    path = shared_folder(spark, "sales-by-region")
    sales = t.sales_totals(spark, d, product=False).select("region", "sales", "revenue")
    sinks.write_partitioned(sales, path, ["region"])
    some = files.scan_parquet(spark, path).filter(F.col("region").isin("ASIA", "EUROPE"))
    return some.groupBy("region").agg(
        F.sum("sales").alias("transaction_count"), cents_total(F.col("revenue")).alias("total_sales")
    )


@query(f"""
SELECT category, count(*) AS n, {t.sql_mean('price')} AS avg_price FROM {t.SALES} GROUP BY category
""")
def prepartitioned_agg(spark: SparkSession, d: str) -> DataFrame:
    """Aggregate over rows already laid out by (group key, lane), each key over several tasks: the
    layout serves the first aggregate as it is, and one row per key and lane is merged after. Lines are
    added up per product before products are named."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    totals = t.sales_totals(spark, d, region=False)
    rows = totals.select("category", "sales", "prices", "priced", F.pmod(F.xxhash64("product_id"), F.lit(n)).alias("lane"))
    laid = layout.by_hash(rows, ["category", "lane"], n)
    lanes = laid.groupBy("category", "lane").agg(F.sum("sales").alias("n"), F.sum("prices").alias("prices"), F.sum("priced").alias("priced"))
    return lanes.groupBy("category").agg(F.sum("n").alias("n"), cents_ratio(F.sum("prices"), F.sum("priced")).alias("avg_price"))


@query("""
SELECT c_mktsegment, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(10,2))) AS DOUBLE) AS spent
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_mktsegment
""")
def bucketed_join(spark: SparkSession, d: str) -> DataFrame:
    """Two tables bucketed by customer: their join and the group by customer need no exchange."""
    n = partitions_for(t.table(spark, d, "customer"))
    people = t.customers(spark, d).select("customer_id", "department")
    spent = t.orders(spark, d).groupBy("customer_id").agg(F.count("*").alias("n"), F.sum("price").alias("spent"))
    left, right = (sinks.bucketed(rows, "customer_id", n, shared_folder(spark, "bucketed")) for rows in (people, spent))
    joined = left.join(right.hint("merge"), "customer_id")
    grouped = joined.groupBy(F.col("department").alias("c_mktsegment"))
    return grouped.agg(F.sum("n").alias("n"), total(F.col("spent")).alias("spent"))
