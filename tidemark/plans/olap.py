"""Cubes, rollups and sales reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import cents_mean, cents_ratio, cents_rounded, cents_total, cents_value, ratio
from tidemark.operators import olap
from tidemark.plans import tables as t
from tidemark.plans.registry import query

# Names of the aggregation levels.
CUBE_LEVELS = {0: "Region_Category", 1: "Region_Only", 2: "Category_Only", 3: "Grand_Total"}
ROLLUP_LEVELS = {0: "Level_1_Region_Category", 1: "Level_2_Region_Only", 3: "Level_3_Grand_Total"}


def _revenue() -> dict:
    return {"total_revenue": F.col("revenue")}


def _avg_price() -> Column:
    return cents_ratio(F.sum("prices"), F.sum("priced"))


def _in_money(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: cents_value(n) for n in names})


@query(f"""
SELECT region, category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(*) AS total_sales
FROM {t.SALES} GROUP BY CUBE (region, category)
""")
def cube_revenue(spark: SparkSession, d: str) -> DataFrame:
    cubed = olap.cube(t.sales_totals(spark, d), ["region", "category"], {**_revenue(), "total_sales": F.col("sales")})
    return _in_money(cubed, "total_revenue").drop("level").orderBy("region", "category")


@query(f"""
SELECT region, category, product, CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM {t.SALES} GROUP BY CUBE (region, category, product)
""")
def cube3_revenue(spark: SparkSession, d: str) -> DataFrame:
    cubed = olap.cube(t.sales_totals(spark, d), ["region", "category", "product"], _revenue())
    return _in_money(cubed, "total_revenue").drop("level")


@query(f"""
SELECT region, category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(*) AS total_sales,
  CASE grouping(region) * 2 + grouping(category) WHEN 0 THEN 'Region_Category' WHEN 1 THEN 'Region_Only'
    WHEN 2 THEN 'Category_Only' ELSE 'Grand_Total' END AS aggregation_level
FROM {t.SALES} GROUP BY CUBE (region, category)
""")
def cube_levels(spark: SparkSession, d: str) -> DataFrame:
    cubed = olap.cube(t.sales_totals(spark, d), ["region", "category"], {**_revenue(), "total_sales": F.col("sales")})
    named = olap.label_levels(cubed, CUBE_LEVELS, "aggregation_level")
    return _in_money(named, "total_revenue").orderBy("region", "category", "aggregation_level")


def _rollup(spark: SparkSession, d: str) -> DataFrame:
    sums = {**_revenue(), "prices": F.col("prices"), "n": F.col("priced")}
    rolled = olap.rollup(t.sales_totals(spark, d), ["region", "category"], sums)
    priced = rolled.withColumn("avg_price", cents_ratio(F.col("prices"), F.col("n"))).drop("prices", "n")
    return _in_money(priced, "total_revenue")


@query(f"""
SELECT region, category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, {t.sql_mean('price')} AS avg_price
FROM {t.SALES} GROUP BY ROLLUP (region, category)
""")
def rollup_revenue(spark: SparkSession, d: str) -> DataFrame:
    return _rollup(spark, d).drop("level").orderBy("region", "category")


@query(f"""
SELECT region, category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, {t.sql_mean('price')} AS avg_price,
  CASE grouping(region) * 2 + grouping(category) WHEN 0 THEN 'Level_1_Region_Category'
    WHEN 1 THEN 'Level_2_Region_Only' ELSE 'Level_3_Grand_Total' END AS hierarchy_level
FROM {t.SALES} GROUP BY ROLLUP (region, category)
""")
def rollup_levels(spark: SparkSession, d: str) -> DataFrame:
    named = olap.label_levels(_rollup(spark, d), ROLLUP_LEVELS, "hierarchy_level")
    return named.orderBy("hierarchy_level", "region", "category")


@query(f"""
SELECT region, category, product, CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM {t.SALES} GROUP BY GROUPING SETS ((region), (category), (product))
""")
def grouping_sets_totals(spark: SparkSession, d: str) -> DataFrame:
    totals = olap.single_key_totals(t.sales_totals(spark, d), ["region", "category", "product"], _revenue())
    return _in_money(totals, "total_revenue").drop("level")


@query(f"""
SELECT CAST(year(sale_date) AS INTEGER) AS year, CAST(quarter(sale_date) AS INTEGER) AS quarter,
  CAST(month(sale_date) AS INTEGER) AS month, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
  count(*) AS sales_count, count(DISTINCT region) AS regions_active
FROM {t.SALES} GROUP BY ALL
""")
def time_analysis(spark: SparkSession, d: str) -> DataFrame:
    day = F.col("sale_date")
    rows = t.sales_totals(spark, d, product=False, year=F.year(day), quarter=F.quarter(day), month=F.month(day))
    report = rows.groupBy("year", "quarter", "month").agg(
        cents_total(F.col("revenue")).alias("total_revenue"),
        F.sum("sales").alias("sales_count"),
        F.count_distinct("region").alias("regions_active"),
    )
    return report.orderBy("year", "quarter", "month")


@query(f"""
SELECT region, category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, {t.sql_mean('price')} AS avg_price,
  CAST(sum(quantity) AS BIGINT) AS total_quantity FROM {t.SALES} GROUP BY region, category
""")
def geo_analysis(spark: SparkSession, d: str) -> DataFrame:
    report = t.sales_totals(spark, d).groupBy("region", "category").agg(
        cents_total(F.col("revenue")).alias("total_revenue"),
        _avg_price().alias("avg_price"),
        F.sum("quantity").alias("total_quantity"),
    )
    return report.orderBy(F.desc("total_revenue"))


@query(f"""
SELECT category, product, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(*) AS sales_frequency,
  {t.sql_mean('quantity')} AS avg_quantity_per_sale FROM {t.SALES} GROUP BY category, product
""")
def product_performance(spark: SparkSession, d: str) -> DataFrame:
    report = t.sales_totals(spark, d, region=False).groupBy("category", "product").agg(
        cents_total(F.col("revenue")).alias("total_revenue"),
        F.sum("sales").alias("sales_frequency"),
        ratio(F.sum("quantity"), F.sum("counted")).alias("avg_quantity_per_sale"),
    )
    return report.orderBy("category", F.desc("total_revenue"))


@query(f"""
SELECT region, CAST(quarter(sale_date) AS INTEGER) AS quarter, CAST(sum(revenue) AS DOUBLE) AS quarterly_revenue,
  count(DISTINCT category) AS categories_sold, {t.sql_mean('price')} AS avg_price,
  {t.sql_cents('sum(revenue)', 'count(DISTINCT category)')} AS revenue_per_category
FROM {t.SALES} GROUP BY ALL
""")
def cross_region_quarter(spark: SparkSession, d: str) -> DataFrame:
    rows = t.sales_totals(spark, d, quarter=F.quarter("sale_date"))
    grouped = rows.groupBy("region", "quarter").agg(
        F.sum("revenue").alias("quarterly_revenue"),
        F.count_distinct("category").alias("categories_sold"),
        _avg_price().alias("avg_price"),
    )
    per_category = cents_rounded(F.col("quarterly_revenue"), F.col("categories_sold"))
    report = grouped.withColumn("revenue_per_category", per_category)
    return _in_money(report, "quarterly_revenue").orderBy("region", "quarter")


@query(f"""
SELECT region, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(*) AS total_sales,
  count(DISTINCT product) AS products_sold, {t.sql_mean('price')} AS avg_price,
  CAST(max(price) AS DOUBLE) AS highest_sale, CAST(min(price) AS DOUBLE) AS lowest_sale,
  {t.sql_cents('sum(revenue)', 'count(*)')} AS avg_sale_value
FROM {t.SALES} GROUP BY region
""")
def regional_dashboard(spark: SparkSession, d: str) -> DataFrame:
    grouped = t.sales_totals(spark, d).groupBy("region").agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("sales").alias("total_sales"),
        F.count_distinct("product").alias("products_sold"),
        _avg_price().alias("avg_price"),
        cents_value(F.max("highest")).alias("highest_sale"),
        cents_value(F.min("lowest")).alias("lowest_sale"),
    )
    report = grouped.withColumn("avg_sale_value", cents_rounded(F.col("total_revenue"), F.col("total_sales")))
    return _in_money(report, "total_revenue").orderBy(F.desc("total_revenue"))


@query(f"""
SELECT category, CAST(sum(revenue) AS DOUBLE) AS total_revenue, CAST(sum(quantity) AS BIGINT) AS total_units_sold,
  count(*) AS number_of_transactions, count(DISTINCT region) AS regions_sold_in,
  {t.sql_cents('sum(revenue)', 'CAST(sum(quantity) AS HUGEINT)')} AS revenue_per_unit,
  {t.sql_cents('sum(revenue)', 'count(*)')} AS avg_transaction_size
FROM {t.SALES} GROUP BY category
""")
def category_performance(spark: SparkSession, d: str) -> DataFrame:
    grouped = t.sales_totals(spark, d).groupBy("category").agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("sales").alias("number_of_transactions"),
        F.count_distinct("region").alias("regions_sold_in"),
    )
    report = grouped.withColumns({
        "revenue_per_unit": cents_rounded(F.col("total_revenue"), F.col("total_units_sold")),
        "avg_transaction_size": cents_rounded(F.col("total_revenue"), F.col("number_of_transactions")),
    })
    return _in_money(report, "total_revenue").orderBy(F.desc("total_revenue"))


# --------------------------------------------------------------------- ranking and growth


@query(f"""
SELECT * FROM (SELECT region, product, CAST(revenue AS DOUBLE) AS product_revenue, sales_count,
    CAST(rank() OVER (PARTITION BY region ORDER BY revenue DESC) AS INTEGER) AS rank
  FROM (SELECT region, product, sum(revenue) AS revenue, count(*) AS sales_count
        FROM {t.SALES} GROUP BY region, product) g) r WHERE rank <= 3
""")
def top_products_by_region(spark: SparkSession, d: str) -> DataFrame:
    grouped = t.sales_totals(spark, d).groupBy("region", "product").agg(
        F.sum("revenue").alias("product_revenue"), F.sum("sales").alias("sales_count")
    )
    best = olap.top_per_group(grouped, ["region"], "product_revenue", 3)
    return _in_money(best, "product_revenue").orderBy("region", "rank")


@query(f"""
SELECT month, monthly_revenue, avg_price, sales_count, prev_revenue,
  (monthly_revenue - prev_revenue) / prev_revenue * 100 AS growth_rate
FROM (SELECT *, lag(monthly_revenue) OVER (ORDER BY month) AS prev_revenue FROM
  (SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, CAST(sum(revenue) AS DOUBLE) AS monthly_revenue,
     {t.sql_mean('price')} AS avg_price, count(*) AS sales_count FROM {t.LINES} GROUP BY 1) m) g
""")
def monthly_growth(spark: SparkSession, d: str) -> DataFrame:
    months = t.lines(spark, d).groupBy(F.trunc("sale_date", "MM").alias("month")).agg(
        cents_total(F.col("revenue")).alias("monthly_revenue"),
        cents_mean(F.col("price")).alias("avg_price"),
        F.count("*").alias("sales_count"),
    )
    grown = olap.growth(months, "month", "monthly_revenue").withColumnRenamed("previous", "prev_revenue")
    return grown.orderBy("month")


@query("""
SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM (SELECT *,
  row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer) r
WHERE rn = 1
""")
def dedup_by_key(spark: SparkSession, d: str) -> DataFrame:
    """One customer per nation and segment: the one with the highest balance."""
    rows = t.table(spark, d, "customer")
    kept = olap.first_per_key(rows, ["c_nationkey", "c_mktsegment"], [F.desc("c_acctbal"), F.asc("c_custkey")])
    return kept.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
