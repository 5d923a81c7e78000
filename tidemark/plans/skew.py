"""Skewed keys, on user activity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numbers import cents_total, cents_value
from tidemark.operators import skew
from tidemark.plans import tables as t
from tidemark.plans.registry import query
from tidemark.session import written

# Users with at least this share of the events count as hot.
HOT_SHARE = 0.007


def _hot(spark: SparkSession, d: str) -> DataFrame:
    """Found once and written, as the jobs below use them several times."""
    found = skew.hot_keys(t.table(spark, d, "events").select("user_id"), ["user_id"], HOT_SHARE)
    return written(found, "hot-users")


@query(f"""
SELECT user_id, n, CAST(n AS DOUBLE) / tot AS share, CAST(n AS DOUBLE) / tot >= {HOT_SHARE} AS is_hot
FROM (SELECT user_id, count(*) AS n, (SELECT count(*) FROM events) AS tot FROM events GROUP BY user_id) c
""")
def hot_keys(spark: SparkSession, d: str) -> DataFrame:
    return skew.key_shares(t.table(spark, d, "events"), ["user_id"], HOT_SHARE)


@query(f"""
SELECT user_id, n, CAST(n AS DOUBLE) / tot AS share FROM (
  SELECT user_id, count(*) AS n, (SELECT count(*) FROM events) AS tot FROM events GROUP BY user_id) c WHERE CAST(n AS DOUBLE) / tot >= {HOT_SHARE}
""")
def heavy_users(spark: SparkSession, d: str) -> DataFrame:
    """The hot rows of hot_keys, found by a sketch and an exact recount of its candidates."""
    return skew.heavy_hitters(t.table(spark, d, "events"), ["user_id"], HOT_SHARE)


@query(f"""
SELECT user_id, CAST(sum(value) AS DOUBLE) AS total_amount, count(*) AS n FROM {t.EVENTS} GROUP BY user_id
""")
def salted_agg(spark: SparkSession, d: str) -> DataFrame:
    rows = t.events(spark, d).select("event_id", "user_id", "value")
    sums = {"total_amount": F.col("value")}
    totals = skew.salted_totals(rows, ["user_id"], sums, _hot(spark, d), ["event_id"])
    return totals.select("user_id", cents_value("total_amount").alias("total_amount"), "n")


_JOINED_SQL = f"""
SELECT department, event_type, count(*) AS n, CAST(sum(value) AS DOUBLE) AS total_amount
FROM {t.EVENTS} JOIN {t.CUSTOMERS} ON user_id = customer_id GROUP BY department, event_type
"""


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    events = t.events(spark, d).select("event_id", "user_id", "event_type", "value")
    people = t.customers(spark, d).select(F.col("customer_id").alias("user_id"), "department")
    return events, people


def _report(joined: DataFrame) -> DataFrame:
    grouped = joined.groupBy("department", "event_type")
    return grouped.agg(F.count("*").alias("n"), cents_total(F.col("value")).alias("total_amount"))


@query(_JOINED_SQL)
def salted_join(spark: SparkSession, d: str) -> DataFrame:
    events, people = _sides(spark, d)
    return _report(skew.salted_join(events, people, ["user_id"], _hot(spark, d), ["event_id"]))


@query(_JOINED_SQL)
def hot_key_split_join(spark: SparkSession, d: str) -> DataFrame:
    events, people = _sides(spark, d)
    hot = skew.heavy_hitters(events, ["user_id"], HOT_SHARE)
    return _report(skew.hot_key_split_join(events, people, ["user_id"], hot, ["event_id"]))
