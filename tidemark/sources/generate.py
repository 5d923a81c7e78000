"""Repeatable generated tables for tests and demonstrations.

Rows come from ``spark.range`` and hashes of the row number, so that any size is made by
the executors and the same row is always the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

REGIONS = ["coast", "valley", "hills", "plain"]
PRODUCTS = {
    "garden": ["spade", "hose", "trellis", "seeds"],
    "kitchen": ["kettle", "ladle", "grater"],
    "music": ["fiddle", "drum"],
    "sport": ["racket", "rope", "ball"],
}


def draw(label: str, n: int) -> Column:
    """A number in 0..n-1 from the row number."""
    return F.pmod(F.xxhash64("id", F.lit(label)), F.lit(n)).cast("int")


def pick(label: str, values: list[str]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), draw(label, len(values)))


def price(label: str, low: int, high: int) -> Column:
    return (F.lit(low * 100) + draw(label, (high - low) * 100 + 1)) / F.lit(100.0)


def sales(spark: SparkSession, n: int = 1000, year: int = 2024) -> DataFrame:
    """Sales over one year by region, category and product, with revenue."""
    pairs = [f"{c}/{p}" for c, products in PRODUCTS.items() for p in products]
    rows = spark.range(1, n + 1).select(
        F.col("id").cast("int").alias("sale_id"),
        pick("region", REGIONS).alias("region"),
        F.split(pick("product", pairs), "/").alias("pair"),
        (draw("quantity", 10) + 1).alias("quantity"),
        price("price", 10, 500).alias("price"),
        F.date_add(F.make_date(F.lit(year), F.lit(1), F.lit(1)), draw("day", 365)).alias("sale_date"),
    )
    return rows.select(
        "sale_id", "region", F.col("pair")[0].alias("category"), F.col("pair")[1].alias("product"),
        "quantity", "price", "sale_date", (F.col("quantity") * F.col("price")).alias("revenue"),
    )


def activity(spark: SparkSession, n: int = 50, users: int = 50) -> DataFrame:
    """User activity with text times, as it arrives in files: one event every ten seconds."""
    second = (F.col("id") * 10).cast("timestamp").cast("timestamp_ntz")
    return spark.range(n).select(
        F.date_format(second + F.expr("INTERVAL 19723 DAYS"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        (draw("user", users) + 1).alias("user_id"),
        pick("action", ["view", "click", "add_to_cart", "purchase", "remove_from_cart"]).alias("action"),
        pick("item", [p for products in PRODUCTS.values() for p in products]).alias("product"),
        price("value", 1, 500).cast("decimal(10,2)").alias("value"),
    )


def skewed(spark: SparkSession, n: int = 10_000, hot_share: float = 0.8, cold_keys: int = 20) -> DataFrame:
    """``hot_share`` of the rows on the key ``busy``, the rest over ``cold_keys`` keys."""
    is_hot = draw("hot", 10_000) < int(hot_share * 10_000)
    cold = F.concat(F.lit("calm_"), draw("cold", cold_keys).cast("string"))
    return spark.range(n).select(
        F.when(is_hot, F.lit("busy")).otherwise(cold).alias("key"),
        F.concat(F.lit("row "), F.col("id")).alias("value"),
        (draw("amount", 60) + 1).alias("amount"),
    )


def zipf_like(spark: SparkSession, n: int = 10_000, keys: int = 100) -> DataFrame:
    """Key k drawn with a frequency near 1/k."""
    u = (draw("u", 1_000_000) + 1) / F.lit(1_000_001.0)
    k = F.floor(F.pow(F.lit(float(keys)), u)).cast("int")
    return spark.range(n).select(k.alias("key"), price("amount", 1, 100).alias("amount"))


def time_series(spark: SparkSession, n: int = 8_000, year: int = 2023, sensors: int = 12) -> DataFrame:
    """Readings of some sensors on the days of a year."""
    return spark.range(n).select(
        F.col("id").cast("int").alias("id"),
        F.date_add(F.make_date(F.lit(year), F.lit(1), F.lit(1)), draw("day", 365)).alias("date"),
        F.concat(F.lit("probe "), draw("sensor", sensors)).alias("sensor_id"),
        price("temperature", -5, 30).alias("temperature"),
        draw("reading", 400).alias("reading"),
    )


#: Rows and distinct categories of each pattern of ``mixed_volume``.
VOLUMES = {"bulk": (6000, 80), "steady": (2000, 40), "rare": (400, 8)}


def mixed_volume(spark: SparkSession, scale: int = 1) -> DataFrame:
    """Patterns of very different size, as ``VOLUMES`` times ``scale`` rows."""
    turn = sum(rows for rows, _ in VOLUMES.values())
    step = F.pmod(F.col("id"), F.lit(turn))
    pattern, width, upto = F.lit(None).cast("string"), F.lit(None).cast("int"), turn
    for name, (rows, categories) in reversed(VOLUMES.items()):
        pattern = F.when(step < upto, name).otherwise(pattern)
        width = F.when(step < upto, categories).otherwise(width)
        upto -= rows
    return spark.range(turn * scale).select(
        F.col("id").cast("int").alias("id"),
        pattern.alias("pattern_type"),
        F.concat(F.lit("c"), F.pmod(F.col("id"), width)).alias("category"),
        price("amount", 2, 900).alias("amount"),
        (draw("quantity", 30) + 1).alias("quantity"),
    )


def region_sales(spark: SparkSession, n: int = 6_000, year: int = 2023) -> DataFrame:
    """Sales of shops by region and day."""
    return spark.range(n).select(
        F.col("id").cast("int").alias("sale_id"),
        pick("region", REGIONS).alias("region"),
        F.concat(F.lit("shop "), draw("store", 35)).alias("store"),
        pick("product", [p for products in PRODUCTS.values() for p in products]).alias("product"),
        price("amount", 5, 300).alias("amount"),
        F.date_add(F.make_date(F.lit(year), F.lit(1), F.lit(1)), draw("day", 365)).alias("date"),
    )
