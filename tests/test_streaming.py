"""Restart, late rows and several batches."""

from __future__ import annotations

import os
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import words
from tidemark.session import shared_folder, using
from tidemark.operators import quality
from tidemark.sources import generate, sinks, streams
from tidemark.streaming import runner, stateful, timelines, windows
from tests.conftest import rows

START = datetime(2024, 1, 1)
SCHEMA = "ts timestamp, user_id bigint, kind string, value bigint"


def add(spark, folder, *data):
    """Let one more file arrive: (minute, user, kind, value)."""
    events = [(START + timedelta(minutes=m), u, k, v) for m, u, k, v in data]
    spark.createDataFrame(events, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture()
def folders(spark):
    return shared_folder(spark, "in"), shared_folder(spark, "out")


def source(spark, folder):
    return spark.readStream.schema(SCHEMA).parquet(folder)


def five_minutes(spark, folder):
    rows = source(spark, folder).withWatermark("ts", "10 minutes")
    grouped = windows.windowed(rows, "ts", "5 minutes", [], [F.count("*").alias("n")])
    return grouped.select(F.col("window.start").alias("start"), "n")


def read(spark, out, stream):
    return {(s - START).seconds // 60: n for s, n in spark.read.schema(stream.schema).parquet(f"{out}/data").collect()}


def test_restart_repeats_nothing(spark, folders):
    arrive, out = folders
    add(spark, arrive, (0, 1, "a", 1), (1, 1, "a", 1), (30, 1, "a", 1))
    stream = five_minutes(spark, arrive)
    runner.finish(runner.append_to_files(stream, out))
    assert read(spark, out, stream) == {0: 2}
    runner.finish(runner.append_to_files(stream, out))  # nothing new
    add(spark, arrive, (31, 1, "a", 1), (60, 1, "a", 1))
    runner.finish(runner.append_to_files(five_minutes(spark, arrive), out))
    assert spark.read.parquet(f"{out}/data").count() == 2
    assert read(spark, out, stream) == {0: 2, 30: 2}


def test_rows_behind_the_watermark_are_counted_and_left_out(spark, folders):
    arrive, out = folders
    add(spark, arrive, (0, 1, "a", 1), (30, 1, "a", 1))
    stream = five_minutes(spark, arrive)
    runner.finish(runner.append_to_files(stream, out))
    add(spark, arrive, (1, 1, "late", 1), (28, 1, "in time", 1), (90, 1, "a", 1))
    progress = runner.finish(runner.append_to_files(stream, out))
    assert runner.late_rows(progress) == 1
    assert runner.state_rows(progress) == 1
    assert read(spark, out, stream) == {0: 1, 25: 1, 30: 1}


def test_updates_keep_the_latest(spark, folders):
    arrive, out = folders
    path = f"{out}/data"

    def run():
        grouped = source(spark, arrive).groupBy("user_id").agg(F.sum("value").alias("v"))
        save = lambda batch, i: runner.save_batch(batch, path, i)
        runner.finish(runner.each_batch(grouped, out, save, "update"))
        return grouped

    add(spark, arrive, (0, 1, "a", 1), (0, 2, "a", 5))
    run()
    add(spark, arrive, (1, 1, "a", 10))
    grouped = run()
    saved = runner.read_batches(spark, path, grouped.schema)
    assert rows(saved.select("user_id", "v", "batch_id")) == [(1, 1, 0), (1, 11, 1), (2, 5, 0)]
    latest = saved.groupBy("user_id").agg(F.max_by("v", "batch_id"))
    assert rows(latest) == [(1, 11), (2, 5)]


def test_a_batch_that_runs_again_replaces_itself(spark, folders):
    path = folders[1]
    runner.save_batch(spark.range(5), path, 3)
    runner.save_batch(spark.range(2), path, 3)
    assert spark.read.parquet(path).count() == 2


def test_several_outputs_of_one_stream(spark, folders):
    arrive, _ = folders
    add(spark, arrive, (0, 1, "a", 100), (0, 2, "b", 5))
    found = runner.replay_outputs(
        source(spark, arrive), "many",
        {"high": lambda b: b.filter("value > 50").select("user_id"), "kinds": lambda b: b.groupBy("kind").count()},
    )
    assert rows(found["high"].select("user_id")) == [(1,)]
    assert rows(found["kinds"].select("kind", "count")) == [("a", 1), ("b", 1)]


def test_a_stream_without_rows_has_an_empty_result(spark, folders):
    arrive, _ = folders
    spark.createDataFrame([], SCHEMA).write.parquet(arrive)
    totals = source(spark, arrive).groupBy("user_id").count()
    assert runner.replay_updates(totals, "empty", ["user_id"]).count() == 0
    assert runner.replay_complete(totals, "empty").count() == 0
    assert runner.replay_partials(source(spark, arrive), "empty", lambda b: b.groupBy("kind").count()).count() == 0
    assert runner.replay(source(spark, arrive), "empty").count() == 0


def test_distinct_counts_in_sliding_windows(spark, folders):
    arrive, _ = folders
    add(spark, arrive, (1, 1, "a", 1), (1, 1, "b", 2), (6, 2, "a", 4), (60, 3, "a", 1))
    rows_in = source(spark, arrive).withWatermark("ts", "1 minute")
    grouped = windows.windowed_distinct(
        rows_in, "ts", "10 minutes", [], {"users": "user_id", "kinds": "kind"}, {"v": F.col("value")},
        {"value": F.col("value")}, "5 minutes",
    )
    shaped = grouped.select(F.col("window.start").alias("s"), "n", "v", "users", "kinds", "min_value", "max_value")
    found = {(r[0] - START).total_seconds() // 60: tuple(r[1:]) for r in runner.replay(shaped, "distinct").collect()}
    assert found == {-5: (2, 3, 1, 2, 1, 2), 0: (3, 7, 2, 2, 1, 4), 5: (1, 4, 1, 1, 4, 4)}


def test_state_of_distinct_counts_does_not_grow_with_the_values(spark, folders):
    arrive, out = folders
    add(spark, arrive, *[(i % 10, i, "a", i) for i in range(500)], (3, 7, None, 1), (4, None, "b", 1))
    grouped = windows.windowed_distinct(
        source(spark, arrive).withWatermark("ts", "1 hour"), "ts", "10 minutes", [], {"users": "user_id", "kinds": "kind"}, {"v": F.col("value")}
    )
    progress = runner.finish(runner.append_to_files(grouped, out))
    assert 0 < runner.state_rows(progress) <= 32 + 3
    # The values come back whole, over two batches.
    add(spark, arrive, (5, 7, "a", 1), (6, 1000, "c", 1), (200, 1, "a", 1))
    runner.finish(runner.append_to_files(grouped, out))
    found = spark.read.schema(grouped.schema).parquet(f"{out}/data").select("n", "v", "users", "kinds")
    assert rows(found) == [(504, 500 * 499 // 2 + 4, 501, 3)]


def test_type_counts(spark, folders):
    arrive, _ = folders
    add(spark, arrive, (0, 1, "b", 1), (1, 1, "a", 7), (2, 1, "b", 3), (60, 1, "a", 0))
    grouped = windows.type_counts(
        source(spark, arrive).withWatermark("ts", "1 minute"), "ts", "10 minutes", ["user_id"], "kind",
        {"total": F.col("value")}, {"most": F.col("value")},
    )
    found = runner.replay(grouped.drop("window", "first_time"), "types")
    assert rows(found) == [(1, 3, 11, 7, "a:1,b:2")]


def test_coarser_windows(spark, folders):
    arrive, _ = folders
    add(spark, arrive, (0, 1, "a", 1), (1, 1, "a", 1), (3, 1, "a", 1), (60, 1, "a", 1))
    fine = windows.windowed(source(spark, arrive).withWatermark("ts", "1 minute"), "ts", "1 minute", [], [F.count("*").alias("n")])
    coarse = windows.coarser(fine, "5 minutes", [], [F.sum("n").alias("n"), F.count("*").alias("parts")])
    assert rows(runner.replay(coarse.select("n", "parts"), "coarse")) == [(3, 3)]


def test_stateful_sessions_across_batches(spark, folders):
    arrive, out = folders

    def run():
        found = stateful.track_sessions(source(spark, arrive), 600, "5 minutes")
        runner.finish(runner.append_to_files(found, out))
        return [
            (u, (s - START).seconds // 60, (e - START).seconds // 60, n, v)
            for u, s, e, n, v in rows(spark.read.schema(found.schema).parquet(f"{out}/data"))
        ]

    add(spark, arrive, (0, 1, "a", 100), (9, 1, "a", 250), (3, 2, "a", 100))
    assert run() == []
    # User 1 goes on within the gap, across the restart; user 2 has timed out by then.
    add(spark, arrive, (18, 1, "a", 100), (40, 3, "a", 100))
    assert run() == [(1, 0, 18, 3, 4.5), (2, 3, 3, 1, 1.0)]
    add(spark, arrive, (41, 3, "a", 100), (100, 4, "a", 100))
    assert run() == [(1, 0, 18, 3, 4.5), (2, 3, 3, 1, 1.0), (3, 40, 41, 2, 2.0)]


def test_stateful_sessions_keep_every_key_and_digit(spark, folders):
    arrive, out = folders
    big = 2**53 + 1
    for batch in ([(0, None, "a", 100), (1, big, "a", None), (5, big - 1, "a", 12345)], [(4, None, "a", None), (30, 7, "a", 1)], [(2, 7, "late", 1), (90, 8, "a", 1)]):
        add(spark, arrive, *batch)
        found = stateful.track_sessions(source(spark, arrive), 600, "5 minutes", key_col="user_id")
        runner.finish(runner.append_to_files(found, out))
    got = [(u, n, v) for u, _, _, n, v in rows(spark.read.schema(found.schema).parquet(f"{out}/data"))]
    assert sorted(got, key=repr) == sorted([(None, 2, 1.0), (big, 1, None), (big - 1, 1, 123.45), (7, 1, 0.01)], key=repr)


def test_csv_stream_checks_headers(spark, folders):
    arrive, out = folders
    good = spark.createDataFrame([("2024-01-01 00:00:00", 1, "view", "pen", 1)], "timestamp string, user_id int, action string, product string, value int")
    good.write.option("header", "true").csv(arrive)
    stream = streams.csv_stream(spark, arrive, schemas.declared("user_activity_raw"))
    parsed = stream.withColumn("timestamp", F.to_timestamp("timestamp", "yyyy-MM-dd HH:mm:ss"))
    runner.finish(runner.append_to_files(parsed, out))
    assert spark.read.parquet(f"{out}/data").first()["timestamp"] == START
    good.drop("product").write.mode("append").option("header", "true").csv(arrive)
    with pytest.raises(StreamingQueryException):
        runner.finish(runner.append_to_files(parsed, out))


def test_generated_files_are_filtered_and_validated(spark, folders):
    """The stateless job: parse times, keep two actions, add the hour, check the rows."""
    arrive, out = folders
    sample = generate.activity(spark, 60)
    sinks.write_csv(sample.repartition(3), arrive)
    stream = streams.csv_stream(spark, arrive, schemas.declared("user_activity_raw"), files_per_batch=1)
    parsed = stream.withColumn("timestamp", F.to_timestamp("timestamp", "yyyy-MM-dd HH:mm:ss"))
    kept = parsed.filter(F.col("action").isin("purchase", "add_to_cart")).withColumn("hour", F.hour("timestamp"))
    checked = quality.validate(kept, quality.activity_rules())
    progress = runner.finish(runner.append_to_files(checked, out))
    assert sum(1 for p in progress if p["numInputRows"]) == 3
    found = spark.read.parquet(f"{out}/data")
    assert found.count() == sample.filter(F.col("action").isin("purchase", "add_to_cart")).count() > 0
    assert rows(found.select("hour", F.size(quality.ERRORS)).distinct()) == [(0, 0)]


def test_text_stream_word_count(spark, folders):
    arrive, _ = folders
    spark.createDataFrame([("a b a",), ("b a",)], "value string").write.text(arrive)
    counts = streams.text_stream(spark, arrive).select(words(F.col("value")).alias("word")).groupBy("word").count()
    assert rows(runner.replay_complete(counts, "words")) == [("a", 3), ("b", 2)]


def test_continuous_query_stops(spark, folders):
    rate = streams.rate_stream(spark, 5, {"user": F.col("value") % 3})
    query = runner.append_to_files(rate, folders[1], every="1 second")
    runner.run_for(query, 4)
    assert not query.isActive


def test_console_output(spark, folders):
    arrive, _ = folders
    add(spark, arrive, (0, 1, "a", 1))
    query = runner.to_console(source(spark, arrive))
    runner.finish(query)
    assert not query.isActive and query.exception() is None


def parts(spark, *batches):
    return [spark.createDataFrame([(START + timedelta(minutes=m), u, k, v) for m, u, k, v in data], SCHEMA) for data in batches]


@pytest.mark.parametrize("cell", [1, 60, 600])
def test_stateful_sessions_like_session_windows(spark, cell):
    """A hot user, a null user and late rows over three arrivals: as ``session_window`` has them, once the cells are closed."""
    hot = [(i / 7, 1, "a", i) for i in range(400)]
    batches = parts(
        spark, [*hot, (3, None, "a", 5), (9, None, "a", None), (30, 2, "a", 1)], [(70, 1, "b", 2), (80, 1, "b", None), (4, 2, "late", 9), (61, None, "a", 1)],
        [(300, 3, "a", 1)],
    )
    ours = runner.replay_arrivals(batches, lambda s: stateful.track_sessions(s, 600, "5 minutes", cell_seconds=cell), "ours")

    def theirs(s):
        grouped = s.withWatermark("ts", "5 minutes").groupBy("user_id", F.session_window("ts", "600 seconds")).agg(
            F.min("ts").alias("session_start"), F.max("ts").alias("session_end"), F.count("*").alias("events"), (F.sum("value") / 100.0).alias("session_value")
        )
        return grouped.drop("session_window")

    assert rows(ours) == rows(runner.replay_arrivals(batches, theirs, "theirs")) and ours.count() == 5
    with pytest.raises(ValueError, match="wider"):
        stateful.track_sessions(batches[0], 600, "5 minutes", cell_seconds=601)


def test_stateful_sessions_end_to_the_millisecond(spark):
    """The newest time less the delay is 00:10:00.500: sessions that end there or before it are reported, in whatever second."""
    whole = 1 / 60
    data = [
        (0, 1, "a", 1), (0.25 * whole, 2, "a", 2), (0.5 * whole, 3, "a", 3), (0.501 * whole, 4, "a", 4),
        # Goes on with the row that has the watermark's own time.
        (0.5 * whole, 5, "a", 5), (10 + 0.5 * whole, 5, "a", 6), (20 + 0.5 * whole, 6, "a", 7),
    ]
    found = runner.replay_arrivals(parts(spark, data), lambda s: stateful.track_sessions(s, 600, "10 minutes"), "grain")
    assert rows(found.select("user_id", "events", "session_value")) == [(1, 1, 0.01), (2, 1, 0.02), (3, 1, 0.03)]


def test_cells_are_joined_before_they_meet():
    name = ["b", None, "a", "b", None, "a", "b"]
    cells = pd.DataFrame({"name": name, "first_us": [9, 1, 4, 0, 8, 5, 20], "last_us": [9, 2, 4, 3, 8, 5, 21], "events": 1, "total": [1, 2, 3, 4, 5, 6, 7], "valued": 1})
    got = [tuple(r) for batch in stateful._join_in_tasks(6, 3)(iter([cells])) for r in batch.itertuples(index=False)]
    assert got == [("b", 0, 9, 2, 5, 2), ("b", 20, 21, 1, 7, 1), (None, 1, 8, 2, 7, 2), ("a", 4, 5, 2, 9, 2)]


def test_timelines_merge_over_batches(spark):
    data = [(0, 1, "a", 1), (5, 1, "b", 2), (7, 2, "a", 3), (9, None, None, 4)], [(6, 1, "a", None), (8, 2, None, 5), (1, 3, "a", 6)], [(2, None, "c", 7), (3, 1, "b", 8)]
    outputs = {
        "parts": lambda b: timelines.batch_parts(b, "user_id", "kind", "ts"),
        "events": lambda b: timelines.batch_timeline(b, "user_id", ["ts", "kind"], ["value"], 2),
    }

    def merged(batches):
        stored = runner.replay_arrivals(parts(spark, *batches), lambda s: s, "timeline", outputs=outputs)
        entry = F.struct(F.minute("ts").alias("minute"), "kind", "value")
        listed = timelines.merged_timeline(stored["events"], "user_id", ["ts", "kind"], entry, 3)
        return rows(timelines.merged_parts(stored["parts"], "user_id", "kind")), rows(listed)

    groups, listed = merged(data)
    # A group with one event in each of two batches counts; a null kind is no kind.
    assert groups == sorted([(1, 4, 2, 360), (2, 2, 1, 60), (None, 2, 1, 420)], key=repr)
    assert [(u, c, n, [tuple(x) for x in t]) for u, c, n, t in listed if u == 1] == [
        (1, 0, 3, [(0, "a", 1), (3, "b", 8), (5, "b", 2)]), (1, 1, 1, [(6, "a", None)])
    ]
    assert merged([[x for b in data for x in b]]) == (groups, listed)


def test_outputs_of_a_batch_that_runs_again(spark):
    folder = shared_folder(spark, "again")
    part = parts(spark, [(0, 1, "a", 1), (1, 1, "b", 1)])[0]
    for _ in range(2):
        runner.save_batch(timelines.batch_parts(part, "user_id", "kind", "ts"), folder, 7)
    saved = runner.read_batches(spark, folder, timelines.batch_parts(part, "user_id", "kind", "ts").schema)
    assert rows(timelines.merged_parts(saved, "user_id", "kind").select("events_in_group")) == [(2,)]


def test_sequences_in_the_stream(spark):
    hot = [(i / 60, 1, "k", i) for i in range(100)]
    batches = parts(spark, [*hot, (3, 2, None, None), (3, 2, "b", 1)], [(60, 9, "z", 0)], [(61, 9, "z", 0), (1, 1, "late", 0)])
    found = runner.replay_arrivals(
        batches, lambda s: windows.event_sequences(s.withWatermark("ts", "1 minute"), "ts", "10 minutes", ["user_id"], ["kind", "value"], slice_seconds=60, chunk=25), "sequences"
    )
    got = {(r.user_id, r.slice_start.minute, r.chunk): [(x.kind, x.value) for x in r.sequence] for r in found.collect()}
    assert [got[1, 0, c] for c in range(3)] == [[("k", i) for i in range(low, min(low + 25, 60))] for low in (0, 25, 50)]
    assert [got[1, 1, c] for c in range(2)] == [[("k", i) for i in range(low, min(low + 25, 100))] for low in (60, 85)]
    assert got[2, 3, 0] == [(None, None), ("b", 1)] and len(got) == 6


def test_late_rows_by_mode(spark):
    batches = parts(spark, [(0, 1, "a", 1), (30, 1, "a", 1)], [(1, 1, "late", 1), (28, 1, "in time", 1)], [(90, 1, "a", 1)])

    def counted(s):
        return windows.windowed(s.withWatermark("ts", "5 minutes"), "ts", "10 minutes", [], [F.count("*").alias("n")]).select(
            F.minute("window.start").alias("minute"), F.hour("window.start").alias("hour"), "n"
        )

    run = lambda mode, **more: {r.minute + 60 * r.hour: r.n for r in runner.replay_arrivals(batches, counted, mode, mode, **more).collect()}
    assert run("append") == {0: 1, 20: 1, 30: 1}
    assert run("update", keys=["minute", "hour"]) == {0: 1, 20: 1, 30: 1, 90: 1}
    assert run("complete") == {0: 2, 20: 1, 30: 1, 90: 1}


def test_null_kinds_have_a_name(spark):
    batches = parts(spark, [(0, 1, "b", 1), (1, 1, None, 1), (2, 1, "b:1", 1), (2, 1, "b", 1)], [(60, 1, "a", 0)])
    grouped = lambda s: windows.type_counts(s.withWatermark("ts", "1 minute"), "ts", "10 minutes", ["user_id"], "kind").select("types")
    assert rows(runner.replay_arrivals(batches, grouped, "types")) == [("b:2,b:1:1,null:1",)]


def test_batches_bounded_by_bytes(spark, folders):
    arrive, out = folders
    for k in range(4):
        add(spark, f"{arrive}/rows.parquet", (k, 1, "a", k))
    stream = streams.table_stream(spark, arrive, "rows", bytes_per_batch="1")
    progress = runner.finish(runner.append_to_files(stream, out))
    assert sum(1 for p in progress if p["numInputRows"]) == 4


def test_figures_of_more_than_a_hundred_batches(spark, folders):
    arrive, out = folders
    count = 104
    for part in range(count):
        # The last row of every tenth file is far behind all others.
        late = [(START, 2)] if part % 10 == 9 else []
        pd.DataFrame([(START + timedelta(minutes=20 * part), 1), *late], columns=["ts", "user_id"]).astype({"ts": "datetime64[us]"}).to_parquet(
            _made(arrive) / f"{part:03}.parquet", index=False
        )
        os.utime(f"{arrive}/{part:03}.parquet", (1_700_000_000 + part, 1_700_000_000 + part))
    with using(spark, {"spark.sql.shuffle.partitions": "1"}):
        stream = spark.readStream.schema("ts timestamp_ntz, user_id long").option("maxFilesPerTrigger", 1).parquet(arrive)
        seen = stream.withColumn("ts", F.col("ts").cast("timestamp")).observe("source", F.count("*").alias("n")).withWatermark("ts", "5 minutes")
        grouped = windows.windowed(seen, "ts", "10 minutes", ["user_id"], [F.count("*").alias("n")])
        with runner.recorded(spark, f"{out}/figures"):
            last = runner.finish(runner.append_to_files(grouped.select("user_id", "n"), out))
    found = runner.progress_table(spark, f"{out}/figures").filter("input_rows > 0")
    assert [tuple(r) for r in found.agg(F.count("*"), F.sum("input_rows"), F.sum("late_rows"), F.sum(F.col("observed")["source.n"].cast("long"))).collect()] == [
        (count, count + 10, 10, count + 10)
    ]
    assert len(last) < count  # the stream itself forgets the first ones
    assert rows(runner.state_sizes(spark, out)) == [(0, 1)]


def _made(folder):
    Path(folder).mkdir(parents=True, exist_ok=True)
    return Path(folder)
