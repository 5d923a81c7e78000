"""Streaming queries: the events and documents tables replayed as streams.

Append-mode results hold the windows that the watermark has closed; the SQL says the same
with ``window_end <= watermark``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import times
from tidemark.functions.numbers import cents_mean, cents_ratio, cents_total, cents_value, mean, ratio
from tidemark.functions.text import json_number, words
from tidemark.operators import intervals, sequences, sessions
from tidemark.plans import tables as t
from tidemark.plans.registry import Query, query
from tidemark.session import STREAM_SETTINGS, partitions_for, using
from tidemark.sources.streams import table_stream
from tidemark.streaming import joins, runner, stateful, timelines, windows

HIGH_VALUE = 50


def _k() -> Column:
    return json_number(F.col("props"), "k")


def stream(spark: SparkSession, d: str, kinds: list[str] | None = None, delay: str | None = None) -> DataFrame:
    """Events as a stream; kinds are filtered before the watermark is set."""
    rows = t.activity(table_stream(spark, d, "events"))
    if kinds:
        rows = rows.filter(F.col("event_type").isin(kinds))
    return rows.withWatermark("ts", delay) if delay else rows


def batch(spark: SparkSession, d: str, kinds: list[str] | None = None, delay: str | None = None) -> DataFrame:
    """The same rows as a bounded table."""
    rows = t.events(spark, d)
    return rows.filter(F.col("event_type").isin(kinds)) if kinds else rows


def streamed(sql: str, source: str = "events") -> Callable[[Query], Query]:
    """Register a streaming query. State keeps the number of partitions it starts with, so
    that number follows the size of the source table."""

    def register(f: Query) -> Query:
        @wraps(f)
        def run(spark: SparkSession, d: str) -> DataFrame:
            n = partitions_for(t.table(spark, d, source))
            with using(spark, {**STREAM_SETTINGS, "spark.sql.shuffle.partitions": str(n)}):
                return f(spark, d)

        return query(sql)(run)

    return register


def _bounds() -> list[Column]:
    return runner.window_bounds()


def _in(kinds: list[str]) -> str:
    return "event_type IN (" + ", ".join(f"'{k}'" for k in kinds) + ")"


def _windowed_sql(size: str, delay: str, body: str, keys: str = "event_type", source: str = t.EVENTS, where: str = "") -> str:
    """Tumbling windows that are closed at the end of the replay."""
    return f"""
SELECT window_start, window_start + INTERVAL {size} AS window_end, {keys}, {body}
FROM (SELECT *, {t.sql_window(size)} AS window_start FROM {source}) w
GROUP BY window_start, {keys} HAVING window_start + INTERVAL {size} <= {t.sql_watermark(delay, where)}
"""


def _sliding_source(slide_minutes: int, size_minutes: int, column: str = "ts", source: str = t.EVENTS) -> str:
    """Each row once per sliding window that holds it."""
    steps = range(0, size_minutes, slide_minutes)
    starts = ", ".join(f"b - INTERVAL {step} MINUTE" for step in steps)
    bucket = t.sql_window(f"{slide_minutes} MINUTE", column)
    return f"(SELECT *, unnest([{starts}]) AS window_start FROM (SELECT *, {bucket} AS b FROM {source}) s) w"


# ------------------------------------------------------------------------- single streams


@streamed("""
SELECT event_id, user_id, event_type, ts, CAST(hour(ts) AS INTEGER) AS hour FROM events
WHERE event_type IN ('purchase', 'click')
""")
def stream_filter_actions(spark: SparkSession, d: str) -> DataFrame:
    rows = stream(spark, d, ["purchase", "click"]).withColumn("processing_time", F.current_timestamp())
    shaped = rows.select(
        "event_id", "user_id", "event_type", times.plain("ts").alias("ts"), F.hour("ts").alias("hour"), "processing_time"
    )
    return runner.replay(shaped, "filter-actions").drop("processing_time")


@streamed(_windowed_sql("5 MINUTE", "10 MINUTE", f"""CAST(sum(value) AS DOUBLE) AS total_sales,
  count(*) AS transaction_count, {t.sql_mean('value')} AS avg_transaction"""))
def stream_tumbling(spark: SparkSession, d: str) -> DataFrame:
    value = F.col("value")
    measures = [cents_total(value).alias("total_sales"), F.count("*").alias("transaction_count"), cents_mean(value).alias("avg_transaction")]
    grouped = windows.windowed(stream(spark, d, delay="10 minutes"), "ts", "5 minutes", ["event_type"], measures)
    shaped = grouped.select(*_bounds(), "event_type", "total_sales", "transaction_count", "avg_transaction")
    return runner.replay(shaped, "tumbling")


@streamed(f"""
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, event_type, CAST(sum(value) AS DOUBLE) AS revenue,
  count(*) AS orders, count(DISTINCT user_id) AS unique_customers,
  count(DISTINCT json_extract_string(props, '$.k')) AS unique_products
FROM {_sliding_source(5, 10)} GROUP BY window_start, event_type
HAVING window_start + INTERVAL 10 MINUTE <= {t.sql_watermark('15 MINUTE')}
""")
def stream_sliding(spark: SparkSession, d: str) -> DataFrame:
    rows = stream(spark, d, delay="15 minutes").withColumn("product", _k())
    grouped = windows.windowed_distinct(
        rows, "ts", "10 minutes", ["event_type"],
        distinct={"unique_customers": "user_id", "unique_products": "product"},
        sums={"revenue": F.col("value")}, slide="5 minutes",
    )
    shaped = grouped.select(
        *_bounds(), "event_type", cents_value("revenue").alias("revenue"),
        F.col("n").alias("orders"), "unique_customers", "unique_products",
    )
    return runner.replay(shaped, "sliding")


@streamed(_windowed_sql("3 MINUTE", "5 MINUTE", """count(*) AS action_count, CAST(sum(value) AS DOUBLE) AS total_value,
  min(ts) AS earliest_event, max(ts) AS latest_event"""))
def stream_late_data(spark: SparkSession, d: str) -> DataFrame:
    """Windows of three minutes that wait five minutes for late rows."""
    measures = [
        F.count("*").alias("action_count"), cents_total(F.col("value")).alias("total_value"),
        times.plain(F.min("ts")).alias("earliest_event"), times.plain(F.max("ts")).alias("latest_event"),
    ]
    grouped = windows.windowed(stream(spark, d, delay="5 minutes"), "ts", "3 minutes", ["event_type"], measures)
    shaped = grouped.select(*_bounds(), "event_type", "action_count", "total_value", "earliest_event", "latest_event")
    return runner.replay(shaped, "late-data")


def _sessions_sql(gap: str, where: str = "TRUE") -> str:
    """Events with the start of the session they belong to."""
    return f"""(SELECT *, max(CASE WHEN opens THEN ts END) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_start
  FROM (SELECT *, coalesce(ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL {gap}, true) AS opens
        FROM {t.EVENTS} WHERE {where}) o) s"""


SESSION_SQL = f"""
SELECT user_id, session_start, max(ts) AS session_end, count(*) AS events_in_session,
  CAST(sum(value) AS DOUBLE) AS session_value FROM {_sessions_sql('10 MINUTE')}
GROUP BY user_id, session_start HAVING max(ts) + INTERVAL 10 MINUTE <= {t.sql_watermark('10 MINUTE')}
"""


@streamed(f"""
SELECT user_id, session_start AS session_window_start, max(ts) + INTERVAL 10 MINUTE AS session_window_end,
  count(*) AS events_in_session, CAST(sum(value) AS DOUBLE) AS session_value, count(DISTINCT event_type) AS unique_actions,
  session_start, max(ts) AS session_end,
  (floor(epoch(max(ts))) - floor(epoch(session_start))) / 60 AS session_duration_minutes
FROM {_sessions_sql('10 MINUTE')} GROUP BY user_id, session_start
HAVING max(ts) + INTERVAL 10 MINUTE <= {t.sql_watermark('10 MINUTE')}
""")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Sessions per user. The set of actions is no longer than the list of action types."""
    grouped = stream(spark, d, delay="10 minutes").groupBy("user_id", F.session_window("ts", "10 minutes")).agg(
        F.count("*").alias("events_in_session"),
        cents_total(F.col("value")).alias("session_value"),
        F.size(F.collect_set("event_type")).cast("bigint").alias("unique_actions"),
        F.min("ts").alias("first"), F.max("ts").alias("last"),
    )
    shaped = grouped.select(
        "user_id",
        times.plain("session_window.start").alias("session_window_start"),
        times.plain("session_window.end").alias("session_window_end"),
        "events_in_session", "session_value", "unique_actions",
        times.plain("first").alias("session_start"), times.plain("last").alias("session_end"),
        times.minutes_between(F.col("first"), F.col("last")).alias("session_duration_minutes"),
    )
    return runner.replay(shaped, "sessions")


@streamed(f"""
SELECT user_id, session_id, {t.sql_window('30 MINUTE')} AS window_start, count(*) AS actions_in_session,
  CAST(sum(value) AS DOUBLE) AS session_value, min(ts) AS session_start, max(ts) AS session_end,
  (floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 60 AS session_duration_minutes
FROM (SELECT *, 'session_' || json_extract_string(props, '$.k') AS session_id FROM {t.EVENTS}) s
GROUP BY user_id, session_id, window_start
""")
def stream_session_stats(spark: SparkSession, d: str) -> DataFrame:
    """Update mode: every change is stored, the latest per (user, session, window) is read."""
    rows = stream(spark, d, delay="10 minutes").withColumn("session_id", F.concat(F.lit("session_"), _k()))
    measures = [
        F.count("*").alias("actions_in_session"), cents_total(F.col("value")).alias("session_value"),
        F.min("ts").alias("first"), F.max("ts").alias("last"),
    ]
    grouped = windows.windowed(rows, "ts", "30 minutes", ["user_id", "session_id"], measures)
    shaped = grouped.select(
        "user_id", "session_id", _bounds()[0], "actions_in_session", "session_value",
        times.plain("first").alias("session_start"), times.plain("last").alias("session_end"),
        times.minutes_between(F.col("first"), F.col("last")).alias("session_duration_minutes"),
    )
    return runner.replay_updates(shaped, "session-stats", ["user_id", "session_id", "window_start"])


@streamed(f"""
SELECT window_start, window_start + INTERVAL 60 MINUTE AS window_end, event_type, CAST(sum(value) AS DOUBLE) AS revenue,
  count(*) AS transactions, count(DISTINCT user_id) AS unique_users,
  count(DISTINCT json_extract_string(props, '$.k')) AS unique_products, {t.sql_mean('value')} AS avg_transaction,
  CAST(min(value) AS DOUBLE) AS min_transaction, CAST(max(value) AS DOUBLE) AS max_transaction
FROM {_sliding_source(15, 60)} GROUP BY window_start, event_type
HAVING window_start + INTERVAL 60 MINUTE <= {t.sql_watermark('15 MINUTE')}
""")
def stream_hourly_rollup(spark: SparkSession, d: str) -> DataFrame:
    rows = stream(spark, d, delay="15 minutes").withColumn("product", _k())
    grouped = windows.windowed_distinct(
        rows, "ts", "1 hour", ["event_type"],
        distinct={"unique_users": "user_id", "unique_products": "product"},
        sums={"revenue": F.col("value")}, extremes={"transaction": F.col("value")}, slide="15 minutes",
    )
    shaped = grouped.select(
        *_bounds(), "event_type",
        cents_value("revenue").alias("revenue"), F.col("n").alias("transactions"),
        "unique_users", "unique_products",
        cents_ratio(F.col("revenue"), F.col("n")).alias("avg_transaction"),
        cents_value("min_transaction").alias("min_transaction"),
        cents_value("max_transaction").alias("max_transaction"),
    )
    return runner.replay(shaped, "hourly-rollup")


ADJUSTED = "(SELECT *, ts + to_seconds(CAST(json_extract(props, '$.k') AS INTEGER)) AS adjusted FROM events) adj"
ADJUSTED_VALUES = ADJUSTED.replace("SELECT *,", "SELECT * REPLACE (CAST(value AS DECIMAL(18,2)) AS value),")


def _adjusted(rows: DataFrame) -> DataFrame:
    """Events moved by ``k`` seconds, to mix their order."""
    return rows.withColumn("adjusted", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _k()))


@streamed(f"""
SELECT user_id, window_start, window_start + INTERVAL 10 MINUTE AS window_end, count(*) AS total_events,
  count(DISTINCT event_type) AS unique_event_types, min(adjusted) AS sequence_start, max(adjusted) AS sequence_end,
  CAST(sum(value) AS DOUBLE) AS total_value,
  CAST(floor(epoch(max(adjusted))) - floor(epoch(min(adjusted))) AS BIGINT) AS sequence_duration_seconds,
  CASE WHEN count(*) > 3 THEN 'complete_sequence' WHEN count(*) > 1 THEN 'partial_sequence' ELSE 'single_event' END AS sequence_completeness
FROM {_sliding_source(5, 10, 'adjusted', ADJUSTED_VALUES)} GROUP BY user_id, window_start
HAVING window_start + INTERVAL 10 MINUTE <= (SELECT max(adjusted) - INTERVAL 5 MINUTE FROM {ADJUSTED})
""")
def stream_entity_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Events of one user in sliding windows; the single events come from entity_event_sequences."""
    rows = _adjusted(stream(spark, d)).withWatermark("adjusted", "5 minutes")
    measures = [
        F.count("*").alias("total_events"),
        F.size(F.collect_set("event_type")).cast("bigint").alias("unique_event_types"),
        F.min("adjusted").alias("first"), F.max("adjusted").alias("last"), cents_total(F.col("value")).alias("total_value"),
    ]
    grouped = windows.windowed(rows, "adjusted", "10 minutes", ["user_id"], measures, "5 minutes")
    n = F.col("total_events")
    completeness = F.when(n > 3, "complete_sequence").when(n > 1, "partial_sequence").otherwise("single_event")
    shaped = grouped.select(
        "user_id", *_bounds(), "total_events", "unique_event_types",
        times.plain("first").alias("sequence_start"), times.plain("last").alias("sequence_end"), "total_value",
        times.seconds_between(F.col("first"), F.col("last")).alias("sequence_duration_seconds"),
        completeness.alias("sequence_completeness"),
    )
    return runner.replay(shaped, "entity-correlation")


@query(f"""
SELECT user_id, window_start, CAST((rn - 1) // 50 AS INTEGER) AS chunk, count(*) AS entries,
  string_agg(event_type, ',' ORDER BY rn) AS sequence
FROM (SELECT user_id, window_start, event_type, row_number() OVER (PARTITION BY user_id, window_start ORDER BY adjusted, event_id) AS rn
  FROM {_sliding_source(5, 10, 'adjusted', ADJUSTED)}) r GROUP BY user_id, window_start, chunk
""")
def entity_event_sequences(spark: SparkSession, d: str) -> DataFrame:
    """The ordered events behind each window of stream_entity_correlation, in chunks of 50."""
    rows = _adjusted(t.events(spark, d)).select(
        "user_id", "event_id", "event_type", "adjusted", F.window("adjusted", "10 minutes", "5 minutes").alias("window")
    )
    rows = rows.withColumn("window_start", times.plain("window.start")).drop("window")
    listed = sequences.chunked_lists(rows, ["user_id", "window_start"], ["adjusted", "event_id"], F.col("event_type"), 50)
    return listed.withColumn("sequence", F.array_join("sequence", ","))


@streamed(_windowed_sql("2 MINUTE", "3 MINUTE", f"""CAST(epoch(window_start) AS BIGINT) AS time_bucket,
  CAST(epoch(window_start) AS BIGINT) % 300 AS five_min_offset, CAST(epoch(window_start) AS BIGINT) % 600 AS ten_min_offset,
  count(*) AS transaction_count, CAST(sum(value) AS DOUBLE) AS total_amount, {t.sql_mean('value')} AS avg_amount,
  min(ts) AS bucket_start, max(ts) AS bucket_end"""))
def stream_time_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Two-minute buckets with their offsets in 5 and 10 minutes, for systems that align so."""
    value = F.col("value")
    measures = [
        F.count("*").alias("transaction_count"), cents_total(value).alias("total_amount"), cents_mean(value).alias("avg_amount"),
        times.plain(F.min("ts")).alias("bucket_start"), times.plain(F.max("ts")).alias("bucket_end"),
    ]
    grouped = windows.windowed(stream(spark, d, delay="3 minutes"), "ts", "2 minutes", ["event_type"], measures)
    start = F.unix_timestamp("window.start")
    shaped = grouped.select(
        *_bounds(), "event_type", start.alias("time_bucket"),
        times.offset_in(start, 300).alias("five_min_offset"), times.offset_in(start, 600).alias("ten_min_offset"),
        "transaction_count", "total_amount", "avg_amount", "bucket_start", "bucket_end",
    )
    return runner.replay(shaped, "time-buckets")


@streamed(f"SELECT user_id, count(*) AS total_actions, CAST(sum(value) AS DOUBLE) AS total_value FROM {t.EVENTS} GROUP BY user_id")
def stream_user_totals(spark: SparkSession, d: str) -> DataFrame:
    """Running totals per user in update mode; the state is two numbers per user."""
    grouped = stream(spark, d).groupBy("user_id").agg(
        F.count("*").alias("total_actions"), cents_total(F.col("value")).alias("total_value")
    )
    return runner.replay_updates(grouped, "user-totals", ["user_id"])


@streamed("SELECT word, count(*) AS count FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) w GROUP BY word", "documents")
def stream_word_count(spark: SparkSession, d: str) -> DataFrame:
    """Running word count over whole texts. A batch stores the words it changed, not the whole table; the
    newest row of each word is the complete result."""
    rows = table_stream(spark, d, "documents").select(words(F.col("text")).alias("word"))
    return runner.replay_updates(rows.groupBy("word").count(), "word-count", ["word"])


@streamed(f"""
SELECT {t.sql_window('1 HOUR')} AS window_start, {t.sql_window('1 HOUR')} + INTERVAL 1 HOUR AS window_end, count(*) AS n
FROM events GROUP BY 1, 2 HAVING {t.sql_window('1 HOUR')} + INTERVAL 1 HOUR <= {t.sql_watermark('10 MINUTE')}
""")
def stream_to_parquet(spark: SparkSession, d: str) -> DataFrame:
    grouped = windows.windowed(stream(spark, d, delay="10 minutes"), "ts", "1 hour", [], [F.count("*").alias("n")])
    return runner.replay(grouped.select(*_bounds(), "n"), "hourly")


@streamed(f"""
SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, event_type, CAST(sum(n) AS BIGINT) AS events,
  max(n) AS busiest_hour FROM (SELECT {t.sql_window('6 HOUR', 'h')} AS window_start, event_type, n FROM
    (SELECT {t.sql_window('1 HOUR')} AS h, event_type, count(*) AS n FROM events GROUP BY ALL) f) c
GROUP BY window_start, event_type HAVING window_start + INTERVAL 6 HOUR <= {t.sql_watermark('10 MINUTE')}
""")
def stream_two_level(spark: SparkSession, d: str) -> DataFrame:
    hours = windows.windowed(stream(spark, d, delay="10 minutes"), "ts", "1 hour", ["event_type"], [F.count("*").alias("n")])
    days = windows.coarser(hours, "6 hours", ["event_type"], [F.sum("n").alias("events"), F.max("n").alias("busiest_hour")])
    return runner.replay(days.select(*_bounds(), "event_type", "events", "busiest_hour"), "two-level")


@streamed(SESSION_SQL)
def stream_stateful_sessions(spark: SparkSession, d: str) -> DataFrame:
    """The sessions of stream_sessions, tracked with a state of our own."""
    found = stateful.track_sessions(stream(spark, d), 600, "10 minutes")
    shaped = found.select(
        "user_id", times.plain("session_start").alias("session_start"), times.plain("session_end").alias("session_end"),
        F.col("events").alias("events_in_session"), "session_value",
    )
    return runner.replay(shaped, "stateful-sessions")


# -------------------------------------------------------------------------- several sinks


def _sinks(spark: SparkSession, d: str, *names: str) -> dict[str, DataFrame]:
    """The named outputs of one stream. The summary stores sums per (user, session) of each
    batch, so a distinct count of sessions needs no set in memory."""
    rows = stream(spark, d).withColumn("session_id", _k()).withColumn("is_high_value", F.col("value") > HIGH_VALUE * 100)

    def high_value(batch: DataFrame) -> DataFrame:
        kept = batch.filter("is_high_value")
        return kept.select("event_id", "user_id", cents_value("value").alias("value"))

    def per_session(batch: DataFrame) -> DataFrame:
        return batch.groupBy("user_id", "session_id").agg(F.count("*").alias("n"), F.sum("value").alias("value"))

    def alerts(batch: DataFrame) -> DataFrame:
        return batch.filter(F.col("event_type") == "error").select("event_id", "user_id", times.plain("ts").alias("ts"))

    every = {"raw": lambda b: b, "high_value": high_value, "sessions": per_session, "alerts": alerts}
    return runner.replay_outputs(rows, "sinks", {name: every[name] for name in names})


@streamed(f"""
SELECT 'raw' AS sink, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM {t.EVENTS}
UNION ALL SELECT 'high_value', count(*), CAST(sum(event_id) AS BIGINT) FROM {t.EVENTS} WHERE value > {HIGH_VALUE}
UNION ALL SELECT 'alerts', count(*), CAST(sum(event_id) AS BIGINT) FROM {t.EVENTS} WHERE event_type = 'error'
UNION ALL SELECT 'sessions', CAST(sum(n) AS BIGINT), CAST(count(*) AS BIGINT) FROM (
  SELECT user_id, json_extract_string(props, '$.k') AS session_id, count(*) AS n FROM {t.EVENTS} GROUP BY 1, 2) s
""")
def multi_sinks(spark: SparkSession, d: str) -> DataFrame:
    """All four outputs of one run: rows and the sum of ids in each; of the summary, events and sessions."""
    stored = _sinks(spark, d, "raw", "high_value", "sessions", "alerts")
    sums = [stored[name].agg(F.lit(name).alias("sink"), F.count("*").alias("n"), F.sum("event_id").alias("ids")) for name in ("raw", "high_value", "alerts")]
    merged = stored["sessions"].groupBy("user_id", "session_id").agg(F.sum("n").alias("n"))
    sums.append(merged.agg(F.lit("sessions").alias("sink"), F.sum("n").alias("n"), F.count("*").alias("ids")))
    return reduce(DataFrame.unionByName, sums)


@streamed(f"SELECT event_id, user_id, CAST(value AS DOUBLE) AS value FROM {t.EVENTS} WHERE value > {HIGH_VALUE}")
def multi_sink_high_value(spark: SparkSession, d: str) -> DataFrame:
    return _sinks(spark, d, "high_value")["high_value"].drop("batch_id")


@streamed(f"""
SELECT user_id, count(*) AS total_actions, CAST(sum(value) AS DOUBLE) AS total_value,
  count(DISTINCT json_extract_string(props, '$.k')) AS unique_sessions FROM {t.EVENTS} GROUP BY user_id
""")
def multi_sink_user_summary(spark: SparkSession, d: str) -> DataFrame:
    parts = _sinks(spark, d, "sessions")["sessions"]
    return parts.groupBy("user_id").agg(
        F.sum("n").alias("total_actions"),
        cents_total(F.col("value")).alias("total_value"),
        F.count_distinct("session_id").alias("unique_sessions"),
    )


@streamed("SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'")
def stream_alerts(spark: SparkSession, d: str) -> DataFrame:
    return _sinks(spark, d, "alerts")["alerts"].drop("batch_id")


@streamed("""
SELECT user_id AS event_group, count(*) AS events_in_group, count(DISTINCT event_type) AS event_kinds,
  CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS time_span_seconds
FROM events GROUP BY user_id HAVING count(*) > 1
""")
def foreach_batch_correlation(spark: SparkSession, d: str) -> DataFrame:
    """Groups with more than one event, and the time they span, merged from what each micro-batch stored."""
    parts = runner.replay_partials(stream(spark, d), "correlation", lambda rows: timelines.batch_parts(rows, "user_id", "event_type", "ts"))
    return timelines.merged_parts(parts, "user_id", "event_type").withColumnRenamed("user_id", "event_group")


# ------------------------------------------------------------------------- several batches

ARRIVALS = 4
#: A row in so many arrives two parts after its time.
LATE_EVERY = 50


def arrivals(spark: SparkSession, d: str) -> list[DataFrame]:
    """Events in parts as they arrive: equal spans of time, but for some that come two parts late."""
    rows = batch(spark, d)
    us = F.unix_micros("ts")
    low, high = rows.agg(F.min(us), F.max(us)).first()
    low, high = low or 0, high or 0
    part = F.least(F.lit(ARRIVALS - 1), F.floor((us - low) * ARRIVALS / (high - low + 1)))
    late = F.least(F.lit(ARRIVALS - 1), part + 2)
    rows = rows.withColumn("arrival", F.when(F.col("event_id") % LATE_EVERY == 0, late).otherwise(part))
    return [rows.filter(F.col("arrival") == k).drop("arrival") for k in range(ARRIVALS)]


# Rows that a window closed by earlier parts does not take any more are dropped, but for complete mode.
def _arrivals_sql(body: str, late: str = "closed IS NULL OR window_start + INTERVAL 1 HOUR > closed", having: str = "TRUE") -> str:
    return f"""
WITH b AS (
  SELECT *, {t.sql_window('1 HOUR')} AS window_start, CASE WHEN event_id % {LATE_EVERY} = 0 THEN least(s + 2, {ARRIVALS - 1}) ELSE s END AS arrival
  FROM (SELECT *, least({ARRIVALS - 1}, ((epoch_us(ts) - low) * {ARRIVALS}) // (high - low + 1)) AS s
    FROM {t.EVENTS}, (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events) m) p),
w AS (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS closed
  FROM b GROUP BY arrival)
SELECT window_start, event_type, {body} FROM b JOIN w USING (arrival) WHERE {late}
GROUP BY window_start, event_type HAVING {having}
"""


_HOURLY = "count(*) AS events, CAST(sum(value) AS DOUBLE) AS total_value, max(ts) AS last_event"


def _hourly(rows: DataFrame) -> DataFrame:
    measures = [F.count("*").alias("events"), cents_total(F.col("value")).alias("total_value"), F.max("ts").alias("last")]
    grouped = windows.windowed(rows.withWatermark("ts", "10 minutes"), "ts", "1 hour", ["event_type"], measures)
    return grouped.select(_bounds()[0], "event_type", "events", "total_value", times.plain("last").alias("last_event"))


@streamed(_arrivals_sql(_HOURLY, having=f"window_start + INTERVAL 1 HOUR <= {t.sql_watermark('10 MINUTE')}"))
def stream_arrivals_append(spark: SparkSession, d: str) -> DataFrame:
    """Hourly totals over four arrivals: final rows as the watermark moves on, late rows dropped."""
    return runner.replay_arrivals(arrivals(spark, d), _hourly, "arrivals-append")


@streamed(_arrivals_sql(_HOURLY))
def stream_arrivals_update(spark: SparkSession, d: str) -> DataFrame:
    """The same in update mode: the latest row of each window, open ones too."""
    return runner.replay_arrivals(arrivals(spark, d), _hourly, "arrivals-update", "update", ["window_start", "event_type"])


@streamed(_arrivals_sql(_HOURLY, late="TRUE"))
def stream_arrivals_complete(spark: SparkSession, d: str) -> DataFrame:
    """The same in complete mode, which keeps all windows and so counts late rows."""
    return runner.replay_arrivals(arrivals(spark, d), _hourly, "arrivals-complete", "complete")


_EVENT_TEXT = "CAST(epoch_us({time}) AS VARCHAR) || ':' || coalesce(event_type, '') || ':' || coalesce(CAST(CAST(value * 100 AS BIGINT) AS VARCHAR), '')"


def _event_text(time: Column, kind: Column, value: Column) -> Column:
    """Time in microseconds, type and value in cents of one event."""
    blank = F.lit("")
    parts = F.unix_micros(time).cast("string"), F.coalesce(kind, blank), F.coalesce(value.cast("bigint").cast("string"), blank)
    return F.array_join(F.array(*parts), ":")


@streamed(f"""
SELECT user_id AS event_group, events_in_group, event_kinds, time_span_seconds, chunk, entries, timeline
FROM (SELECT user_id, count(*) AS events_in_group, count(DISTINCT event_type) AS event_kinds,
    CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS time_span_seconds FROM events GROUP BY user_id HAVING count(*) > 1) g
JOIN (SELECT user_id, CAST((rn - 1) // 50 AS INTEGER) AS chunk, count(*) AS entries, string_agg({_EVENT_TEXT.format(time='ts')}, ',' ORDER BY rn) AS timeline
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM {t.EVENTS}) r GROUP BY user_id, chunk) c USING (user_id)
""")
def foreach_batch_timeline(spark: SparkSession, d: str) -> DataFrame:
    """Groups over four arrivals with every event in order, merged from the parts and chunks that each batch stored."""
    order, fields = ["ts", "event_id"], ["event_type", "value"]
    stored = runner.replay_arrivals(
        arrivals(spark, d), lambda rows: rows, "timelines",
        outputs={
            "parts": lambda rows: timelines.batch_parts(rows, "user_id", "event_type", "ts"),
            "events": lambda rows: timelines.batch_timeline(rows, "user_id", order, fields, 50),
        },
    )
    groups = timelines.merged_parts(stored["parts"], "user_id", "event_type")
    entry = _event_text(F.col("ts"), F.col("event_type"), F.col("value"))
    listed = timelines.merged_timeline(stored["events"], "user_id", order, entry, 50)
    joined = groups.join(listed, "user_id").withColumn("timeline", F.array_join("timeline", ","))
    return joined.withColumnRenamed("user_id", "event_group")


@streamed(f"""
SELECT user_id, window_start, slice_start, CAST((rn - 1) // 5 AS INTEGER) AS chunk, count(*) AS entries,
  string_agg({_EVENT_TEXT.format(time='adjusted')}, ',' ORDER BY rn) AS sequence
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, window_start, slice_start ORDER BY adjusted, event_id) AS rn
  FROM (SELECT *, time_bucket(INTERVAL 60 SECOND, adjusted, TIMESTAMP '1970-01-01') AS slice_start
    FROM {_sliding_source(5, 10, 'adjusted', ADJUSTED_VALUES)}) x) r
WHERE window_start + INTERVAL 10 MINUTE <= (SELECT max(adjusted) - INTERVAL 5 MINUTE FROM {ADJUSTED})
GROUP BY user_id, window_start, slice_start, chunk
""")
def stream_entity_sequences(spark: SparkSession, d: str) -> DataFrame:
    """The events (time, type, value) behind each window of stream_entity_correlation, from the stream itself."""
    rows = _adjusted(stream(spark, d)).withWatermark("adjusted", "5 minutes")
    listed = windows.event_sequences(rows, "adjusted", "10 minutes", ["user_id"], ["event_id", "event_type", "value"], "5 minutes", 60, 5)
    text = F.transform("sequence", lambda x: _event_text(x["time"], x["event_type"], x["value"]))
    shaped = listed.select(
        "user_id", _bounds()[0], times.plain("slice_start").alias("slice_start"), "chunk",
        F.size("sequence").cast("bigint").alias("entries"), F.array_join(text, ",").alias("sequence"),
    )
    return runner.replay(shaped, "entity-sequences")


# ---------------------------------------------------------------------------------- joins

# Reference data: kind of event, name, priority, department. One kind is left out on purpose.
PAGES = [
    ("view", "Viewing", "Critical", "Marketing"),
    ("click", "Clicking", "High", "Sales"),
    ("purchase", "Buying", "Critical", "Revenue"),
    ("signup", "Joining", "Medium", "Support"),
]
PAGE_COLUMNS = "event_type string, page_name string, priority string, department string"
PAGES_SQL = "(VALUES " + ", ".join(str(row) for row in PAGES) + ") p(event_type, page_name, priority, department)"


@streamed(f"""
SELECT window_start, window_end, event_type, coalesce(page_name, 'Unknown') AS page_name, coalesce(priority, 'Low') AS priority,
  coalesce(department, 'Other') AS department, page_views, unique_users, avg_value,
  page_views * CASE priority WHEN 'Critical' THEN 3 WHEN 'High' THEN 2 ELSE 1 END AS priority_score
FROM ({_windowed_sql('1 MINUTE', '2 MINUTE', f"count(*) AS page_views, count(DISTINCT user_id) AS unique_users, {t.sql_mean('value')} AS avg_value")}) w
LEFT JOIN {PAGES_SQL} USING (event_type)
""")
def stream_static_enrich(spark: SparkSession, d: str) -> DataFrame:
    grouped = windows.windowed_distinct(
        stream(spark, d, delay="2 minutes"), "ts", "1 minute", ["event_type"],
        distinct={"unique_users": "user_id"}, sums={"value": F.col("value")},
    )
    pages = spark.createDataFrame(PAGES, PAGE_COLUMNS)
    defaults = {"page_name": "Unknown", "priority": "Low", "department": "Other"}
    enriched = joins.enrich(grouped, pages, "event_type", defaults)
    shaped = enriched.select(
        *_bounds(), "event_type", "page_name", "priority", "department", F.col("n").alias("page_views"), "unique_users",
        cents_ratio(F.col("value"), F.col("n")).alias("avg_value"),
        joins.priority_score(F.col("priority"), F.col("n")).alias("priority_score"),
    )
    return runner.replay(shaped, "static-enrich")


ACTIVITY_KINDS, METRIC_KINDS = ["view", "click", "purchase"], ["error", "signup"]


def _overlap(fine_rows: DataFrame, coarse_rows: DataFrame) -> DataFrame:
    fine = windows.windowed_distinct(
        fine_rows, "ts", "1 hour", ["event_type"], distinct={"unique_users": "user_id"}, sums={"value": F.col("value")}
    )
    coarse = windows.windowed(
        coarse_rows, "ts", "6 hours", ["event_type"], [F.count("*").alias("metric_count"), F.sum("value").alias("metric_sum")]
    ).withColumnRenamed("event_type", "region")
    joined = joins.join_enclosing(fine, coarse, "6 hours")
    return joined.select(
        F.col("fine_start").alias("window_start"), F.col("fine_end").alias("window_end"),
        "event_type", F.col("n").alias("activity_count"), "unique_users",
        cents_ratio(F.col("value"), F.col("n")).alias("avg_value"),
        "region",
        F.coalesce(cents_ratio(F.col("metric_sum"), F.col("metric_count")), F.lit(0.0)).alias("avg_metric"),
        F.coalesce("metric_count", F.lit(0)).alias("metric_count"),
    )


def _overlap_sql(condition: str) -> str:
    return f"""
SELECT f.window_start, f.window_start + INTERVAL 1 HOUR AS window_end, f.event_type, activity_count, unique_users, avg_value,
  region, coalesce(avg_metric, 0) AS avg_metric, coalesce(metric_count, 0) AS metric_count
FROM (SELECT {t.sql_window('1 HOUR')} AS window_start, event_type, count(*) AS activity_count,
    count(DISTINCT user_id) AS unique_users, {t.sql_mean('value')} AS avg_value
    FROM {t.EVENTS} WHERE {_in(ACTIVITY_KINDS)} GROUP BY ALL) f
LEFT JOIN (SELECT {t.sql_window('6 HOUR')} AS start, event_type AS region, {t.sql_mean('value')} AS avg_metric,
    count(*) AS metric_count FROM {t.EVENTS} WHERE {_in(METRIC_KINDS)} GROUP BY ALL) c
ON f.window_start >= c.start AND f.window_start < c.start + INTERVAL 6 HOUR
{condition}
"""


@query(_overlap_sql(""))
def overlap_window_join(spark: SparkSession, d: str) -> DataFrame:
    """Hourly windows joined to the six-hour windows that hold them."""
    return _overlap(batch(spark, d, ACTIVITY_KINDS), batch(spark, d, METRIC_KINDS))


@streamed(_overlap_sql(f"""WHERE {t.sql_window('6 HOUR', 'f.window_start')} + INTERVAL 6 HOUR <= least(
  {t.sql_watermark('2 MINUTE', 'WHERE ' + _in(ACTIVITY_KINDS))}, {t.sql_watermark('5 MINUTE', 'WHERE ' + _in(METRIC_KINDS))})"""))
def stream_overlap_window_join(spark: SparkSession, d: str) -> DataFrame:
    fine, coarse = stream(spark, d, ACTIVITY_KINDS, "2 minutes"), stream(spark, d, METRIC_KINDS, "5 minutes")
    return runner.replay(_overlap(fine, coarse), "overlap-window")


TOLERANCE = 7200


def _views(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("ts").alias("order_time"), F.col("user_id").alias("order_user"), F.col("event_id").alias("order_id"),
        cents_value("value").alias("order_amount"),
    )


def _payments(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("ts").alias("payment_time"), F.col("user_id").alias("payment_user"), F.col("event_id").alias("payment_id"),
        cents_value("value").alias("payment_amount"),
    )


def _tolerance(orders: DataFrame, payments: DataFrame, how: str) -> DataFrame:
    keys = [("order_user", "payment_user")]
    joined = intervals.tolerance_join(orders, payments, keys, "order_time", "payment_time", TOLERANCE, how)
    return joined.select(
        "order_id", F.col("order_user").alias("user_id"), times.plain("order_time").alias("order_time"), "order_amount",
        "payment_id", times.plain("payment_time").alias("payment_time"), "payment_amount",
        times.seconds_between(F.col("order_time"), F.col("payment_time")).alias("payment_delay_seconds"),
    )


def _tolerance_sql(how: str, condition: str = "") -> str:
    return f"""
SELECT o.event_id AS order_id, o.user_id, o.ts AS order_time, o.value AS order_amount, p.event_id AS payment_id,
  p.ts AS payment_time, p.value AS payment_amount,
  CAST(floor(epoch(p.ts)) - floor(epoch(o.ts)) AS BIGINT) AS payment_delay_seconds
FROM (SELECT * FROM events WHERE event_type = 'view') o {how} JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
ON o.user_id = p.user_id AND p.ts >= o.ts AND p.ts <= o.ts + INTERVAL {TOLERANCE} SECOND {condition}
"""


@query(_tolerance_sql("LEFT"))
def tolerance_join(spark: SparkSession, d: str) -> DataFrame:
    """Purchases within two hours after a view by the same user."""
    return _tolerance(_views(batch(spark, d, ["view"])), _payments(batch(spark, d, ["purchase"])), "left")


def _tolerance_streams(spark: SparkSession, d: str, how: str) -> DataFrame:
    orders = _views(stream(spark, d, ["view"])).withWatermark("order_time", "3 minutes")
    payments = _payments(stream(spark, d, ["purchase"])).withWatermark("payment_time", "5 minutes")
    return _tolerance(orders, payments, how)


@streamed(_tolerance_sql("LEFT", f"""WHERE p.ts IS NOT NULL OR o.ts + INTERVAL {TOLERANCE} SECOND <= least(
  {t.sql_watermark('3 MINUTE', "WHERE event_type = 'view'")}, {t.sql_watermark('5 MINUTE', "WHERE event_type = 'purchase'")})"""))
def stream_tolerance_join(spark: SparkSession, d: str) -> DataFrame:
    """Left outer: a view without purchase comes out once none can arrive any more."""
    return runner.replay(_tolerance_streams(spark, d, "left_outer"), "tolerance")


@streamed(_tolerance_sql("INNER"))
def stream_stream_inner(spark: SparkSession, d: str) -> DataFrame:
    return runner.replay(_tolerance_streams(spark, d, "inner"), "stream-inner")


# Gaps are in hours: a user of the test table acts about twice a day.
INTERACTION_GAP, SYSTEM_GAP = 5, 10


def _kind(name: str) -> Column:
    return F.when(F.col("event_type") == name, 1).otherwise(0)


INTERACTION_SUMS = {"views": "view", "clicks": "click", "purchases": "purchase"}
SYSTEM_SUMS = {"errors": "error", "signups": "signup"}


def _session_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Sessions of interactions with the system sessions that overlap them."""
    joined = intervals.overlap_join(
        left, right, ["user_id"], ("session_start", "session_end"), ("system_start", "system_window_end"), 86400, "left"
    )
    return joined.select(
        "user_id", times.plain("session_start").alias("session_start"), times.plain("session_end").alias("session_end"),
        "interaction_count", *INTERACTION_SUMS,
        F.coalesce("system_event_count", F.lit(0)).alias("system_event_count"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in SYSTEM_SUMS], "avg_severity",
        times.seconds_between(F.col("session_start"), F.col("system_start")).alias("system_event_offset_seconds"),
    )


def _session_join_sql(left_closed: str = "TRUE", right_closed: str = "TRUE") -> str:
    lefts = ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS {c}" for c, k in INTERACTION_SUMS.items())
    rights = ", ".join(f"count(*) FILTER (WHERE event_type = '{k}') AS {c}" for c, k in SYSTEM_SUMS.items())
    return f"""
SELECT l.user_id, l.session_start, l.session_end, interaction_count, views, clicks, purchases,
  coalesce(system_event_count, 0) AS system_event_count, coalesce(errors, 0) AS errors, coalesce(signups, 0) AS signups, avg_severity,
  CAST(floor(epoch(system_start)) - floor(epoch(l.session_start)) AS BIGINT) AS system_event_offset_seconds
FROM (SELECT user_id, session_start, max(ts) AS session_end, count(*) AS interaction_count, {lefts}
  FROM {_sessions_sql(f'{INTERACTION_GAP} HOUR', _in(ACTIVITY_KINDS))} GROUP BY user_id, session_start HAVING {left_closed}) l
LEFT JOIN (SELECT user_id, session_start AS system_start, max(ts) + INTERVAL {SYSTEM_GAP} HOUR AS system_window_end,
  count(*) AS system_event_count, {rights}, CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS DOUBLE) / count(*) AS avg_severity
  FROM {_sessions_sql(f'{SYSTEM_GAP} HOUR', _in(METRIC_KINDS))} GROUP BY user_id, session_start HAVING {right_closed}) r
ON l.user_id = r.user_id AND l.session_start <= r.system_window_end AND l.session_end >= r.system_start
"""


@query(_session_join_sql())
def session_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    def found(kinds: list[str], gap_hours: int, sums: dict[str, Column]) -> DataFrame:
        rows = batch(spark, d, kinds)
        return sessions.session_parts(rows, "user_id", "ts", gap_hours * 3600, [], sums)

    left = found(ACTIVITY_KINDS, INTERACTION_GAP, {c: _kind(k) for c, k in INTERACTION_SUMS.items()}).select(
        "user_id", "session_start", F.col("last_time").alias("session_end"),
        F.col("n").alias("interaction_count"), *INTERACTION_SUMS,
    )
    right_sums = {**{c: _kind(k) for c, k in SYSTEM_SUMS.items()}, "severity": _k()}
    right = found(METRIC_KINDS, SYSTEM_GAP, right_sums).select(
        "user_id", F.col("session_start").alias("system_start"),
        (F.col("last_time") + times.seconds_interval(SYSTEM_GAP * 3600)).alias("system_window_end"),
        F.col("n").alias("system_event_count"), *SYSTEM_SUMS,
        ratio(F.col("severity"), F.col("n")).alias("avg_severity"),
    )
    return _session_join(left, right)


@streamed(_session_join_sql(
    f"max(ts) + INTERVAL {INTERACTION_GAP} HOUR <= {t.sql_watermark('10 MINUTE', 'WHERE ' + _in(ACTIVITY_KINDS))}",
    f"max(ts) + INTERVAL {SYSTEM_GAP} HOUR <= {t.sql_watermark('10 MINUTE', 'WHERE ' + _in(METRIC_KINDS))}",
))
def stream_session_overlap_join(spark: SparkSession, d: str) -> DataFrame:
    """Two session streams land as files, and the files are joined.

    Spark does not join two session aggregates left outer inside one streaming query.
    """
    left = stream(spark, d, ACTIVITY_KINDS, "10 minutes").groupBy(
        "user_id", F.session_window("ts", f"{INTERACTION_GAP} hours")
    ).agg(
        F.count("*").alias("interaction_count"), F.min("ts").alias("session_start"), F.max("ts").alias("session_end"),
        *[F.sum(_kind(k)).alias(c) for c, k in INTERACTION_SUMS.items()],
    )
    right = stream(spark, d, METRIC_KINDS, "10 minutes").groupBy(
        "user_id", F.session_window("ts", f"{SYSTEM_GAP} hours")
    ).agg(
        F.count("*").alias("system_event_count"), F.min("ts").alias("system_start"), mean(_k()).alias("avg_severity"),
        *[F.sum(_kind(k)).alias(c) for c, k in SYSTEM_SUMS.items()],
    )
    right = right.withColumn("system_window_end", F.col("session_window.end"))
    landed = [
        runner.replay(side.drop("session_window"), name)
        for side, name in ((left, "interactions"), (right, "system-events"))
    ]
    return _session_join(*landed)


SENSOR_KINDS, ALERT_KINDS, MAINTENANCE_KINDS = ["view", "click"], ["error"], ["purchase"]


def _correlation(sensors: DataFrame, alerts: DataFrame, maintenance: DataFrame) -> DataFrame:
    """Three streams per user and day: readings, alerts, maintenance."""
    alert_type = F.when(_k() % 3 == 0, "high_temp").when(_k() % 3 == 1, "low_humidity").otherwise("sensor_offline")
    work_type = F.when(_k() % 2 == 0, "scheduled").otherwise("emergency")
    readings = windows.windowed(
        sensors, "ts", "1 day", ["user_id", "event_type"],
        [
            F.count("*").alias("sensor_readings"), F.sum("value").alias("temperature"), F.sum(_k()).alias("humidity"),
            F.min("ts").alias("period_start"), F.max("ts").alias("period_end"),
        ],
    )
    alerted = windows.type_counts(
        alerts.withColumn("alert_type", alert_type), "ts", "1 day", ["user_id"], "alert_type",
        maxima={"max_priority": _k() % 3 + 1},
    ).select("window", "user_id", F.col("n").alias("alert_count"), F.col("types").alias("alert_types"), "max_priority")
    worked = windows.type_counts(
        maintenance.withColumn("work_type", work_type), "ts", "1 day", ["user_id"], "work_type",
        sums={"total_maintenance_minutes": _k() + 30},
    ).select(
        "window", "user_id", F.col("n").alias("maintenance_count"), F.col("types").alias("maintenance_types"),
        "total_maintenance_minutes",
    )
    joined = joins.align(readings, [alerted, worked], ["user_id"])
    temperature = cents_ratio(F.col("temperature"), F.col("sensor_readings"))
    humidity = ratio(F.col("humidity"), F.col("sensor_readings"))
    numbers = ["alert_count", "max_priority", "maintenance_count", "total_maintenance_minutes"]
    return joined.select(
        "user_id", times.plain("window.start").alias("time_period"), F.col("event_type").alias("location_type"),
        temperature.alias("avg_temperature"), humidity.alias("avg_humidity"), "sensor_readings",
        times.plain("period_start").alias("period_start"), times.plain("period_end").alias("period_end"),
        *[F.coalesce(F.col(c).cast("bigint"), F.lit(0)).alias(c) for c in numbers], "alert_types", "maintenance_types",
        F.coalesce(F.col("alert_count") > 0, F.lit(False)).alias("has_alerts"),
        F.coalesce(F.col("maintenance_count") > 0, F.lit(False)).alias("has_maintenance"),
        F.coalesce((temperature > 80) | (humidity < 40), F.lit(False)).alias("environmental_issues"),
    )


def _types_sql(kinds: list[str], case: str, column: str, count: str, extra: str) -> str:
    rows = f"""(SELECT user_id, {t.sql_window('1 DAY')} AS w, {case} AS kind, k FROM
      (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE {_in(kinds)}) e) r"""
    return f"""(SELECT user_id, w, CAST(sum(n) AS BIGINT) AS {count}, string_agg(kind || ':' || n, ',' ORDER BY kind) AS {column}, {extra}
      FROM (SELECT user_id, w, kind, count(*) AS n, max(k % 3 + 1) AS top, sum(k + 30) AS minutes FROM {rows} GROUP BY ALL) g GROUP BY ALL)"""


def _correlation_sql(condition: str = "TRUE") -> str:
    alerts = _types_sql(
        ALERT_KINDS, "CASE k % 3 WHEN 0 THEN 'high_temp' WHEN 1 THEN 'low_humidity' ELSE 'sensor_offline' END",
        "alert_types", "alert_count", "max(top) AS max_priority",
    )
    work = _types_sql(
        MAINTENANCE_KINDS, "CASE k % 2 WHEN 0 THEN 'scheduled' ELSE 'emergency' END",
        "maintenance_types", "maintenance_count", "sum(minutes) AS total_maintenance_minutes",
    )
    return f"""
SELECT user_id, w AS time_period, location_type, avg_temperature, avg_humidity, sensor_readings, period_start, period_end,
  coalesce(alert_count, 0) AS alert_count, CAST(coalesce(max_priority, 0) AS BIGINT) AS max_priority,
  coalesce(maintenance_count, 0) AS maintenance_count,
  CAST(coalesce(total_maintenance_minutes, 0) AS BIGINT) AS total_maintenance_minutes, alert_types, maintenance_types,
  coalesce(alert_count, 0) > 0 AS has_alerts, coalesce(maintenance_count, 0) > 0 AS has_maintenance,
  coalesce(avg_temperature > 80 OR avg_humidity < 40, FALSE) AS environmental_issues
FROM (SELECT user_id, {t.sql_window('1 DAY')} AS w, event_type AS location_type, {t.sql_mean('value')} AS avg_temperature,
    CAST(sum(CAST(json_extract(props, '$.k') AS INTEGER)) AS DOUBLE) / count(*) AS avg_humidity, count(*) AS sensor_readings,
    min(ts) AS period_start, max(ts) AS period_end FROM {t.EVENTS} WHERE {_in(SENSOR_KINDS)} GROUP BY ALL) s
LEFT JOIN {alerts} a USING (user_id, w) LEFT JOIN {work} m USING (user_id, w) WHERE {condition}
"""


@query(_correlation_sql())
def multi_stream_correlation(spark: SparkSession, d: str) -> DataFrame:
    return _correlation(*[batch(spark, d, kinds) for kinds in (SENSOR_KINDS, ALERT_KINDS, MAINTENANCE_KINDS)])


@streamed(_correlation_sql(f"""w + INTERVAL 1 DAY <= least({t.sql_watermark('2 MINUTE', 'WHERE ' + _in(SENSOR_KINDS))},
  {t.sql_watermark('5 MINUTE', 'WHERE ' + _in(ALERT_KINDS))}, {t.sql_watermark('10 MINUTE', 'WHERE ' + _in(MAINTENANCE_KINDS))})"""))
def stream_multi_correlation(spark: SparkSession, d: str) -> DataFrame:
    """The same with three streams, each with the delay it needs; the slowest governs."""
    delays = {"2 minutes": SENSOR_KINDS, "5 minutes": ALERT_KINDS, "10 minutes": MAINTENANCE_KINDS}
    return runner.replay(_correlation(*[stream(spark, d, k, w) for w, k in delays.items()]), "multi-correlation")


@streamed(f"""
SELECT s.user_id, s.start AS window_start, m.start AS maint_window_start, avg_temp, reading_count, alert_count, maintenance_events,
  maintenance_types, total_maintenance_time
FROM (SELECT user_id, {t.sql_window('1 HOUR')} AS start, {t.sql_mean('value')} AS avg_temp, count(*) AS reading_count,
    count(*) FILTER (WHERE value > {HIGH_VALUE}) AS alert_count FROM {t.EVENTS} WHERE {_in(SENSOR_KINDS)} GROUP BY user_id, start
    HAVING {t.sql_window('1 HOUR')} + INTERVAL 1 HOUR <= {t.sql_watermark('1 MINUTE', 'WHERE ' + _in(SENSOR_KINDS))}) s
JOIN (SELECT user_id, start, CAST(sum(n) AS BIGINT) AS maintenance_events, string_agg(kind || ':' || n, ',' ORDER BY kind) AS maintenance_types,
    CAST(sum(minutes) AS BIGINT) AS total_maintenance_time FROM (SELECT user_id, {t.sql_window('6 HOUR')} AS start,
      CASE CAST(json_extract(props, '$.k') AS INTEGER) % 3 WHEN 0 THEN 'calibration' WHEN 1 THEN 'cleaning' ELSE 'replacement' END AS kind,
      count(*) AS n, sum(CAST(json_extract(props, '$.k') AS INTEGER) + 30) AS minutes FROM events WHERE {_in(MAINTENANCE_KINDS)} GROUP BY ALL) g
    GROUP BY user_id, start HAVING start + INTERVAL 6 HOUR <= {t.sql_watermark('5 MINUTE', 'WHERE ' + _in(MAINTENANCE_KINDS))}) m
ON s.user_id = m.user_id AND s.start < m.start + INTERVAL 6 HOUR AND s.start + INTERVAL 1 HOUR > m.start
""")
def mediated_window_join(spark: SparkSession, d: str) -> DataFrame:
    """Two streams land as files with windows of their own; a batch job joins them by time."""
    value = F.col("value")
    sensors = windows.windowed(
        stream(spark, d, SENSOR_KINDS, "1 minute"), "ts", "1 hour", ["user_id"],
        [
            cents_mean(value).alias("avg_temp"), F.count("*").alias("reading_count"),
            F.sum(F.when(value > HIGH_VALUE * 100, 1).otherwise(0)).alias("alert_count"),
        ],
    )
    kind = F.when(_k() % 3 == 0, "calibration").when(_k() % 3 == 1, "cleaning").otherwise("replacement")
    maintenance = windows.type_counts(
        stream(spark, d, MAINTENANCE_KINDS, "5 minutes").withColumn("kind", kind), "ts", "6 hours", ["user_id"], "kind",
        sums={"total_maintenance_time": _k() + 30},
    ).withColumnsRenamed({"n": "maintenance_events", "types": "maintenance_types"}).drop("first_time")
    last = F.expr("INTERVAL 1 MICROSECOND")  # windows do not include their end
    left = runner.replay(sensors, "sensor-windows").withColumns(
        {"start": F.col("window.start"), "end": F.col("window.end") - last}
    ).drop("window")
    right = runner.replay(maintenance, "maintenance-windows").withColumns(
        {"maint_start": F.col("window.start"), "maint_end": F.col("window.end") - last}
    ).drop("window")
    joined = intervals.overlap_join(left, right, ["user_id"], ("start", "end"), ("maint_start", "maint_end"), 6 * 3600)
    return joined.select(
        "user_id", times.plain("start").alias("window_start"), times.plain("maint_start").alias("maint_window_start"),
        "avg_temp", "reading_count", "alert_count", "maintenance_events", "maintenance_types", "total_maintenance_time",
    )
