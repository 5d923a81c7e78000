"""Balanced operators against the plain form, on data with one very hot key."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import intervals, joins, layout, olap, sequences, sessions, sketches, skew, slices
from tidemark.sources import generate
from tests.conftest import rows

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def hot(spark):
    return generate.skewed(spark, 4000, 0.8, 20).cache()


# ------------------------------------------------------------------------------- slices


@pytest.fixture(scope="module")
def sliced(hot):
    return slices.ordered_slices(hot, ["key"], ["amount", "value"], 8)


def test_hot_key_spans_several_slices(sliced):
    assert sliced.filter("key = 'busy'").select("_slice").distinct().count() >= 5


def test_running_sum(hot, sliced):
    w = Window.partitionBy("key").orderBy("amount", "value").rowsBetween(Window.unboundedPreceding, 0)
    plain = hot.select("value", F.sum("amount").over(w))
    ours = slices.running_sum(sliced, ["key"], ["amount", "value"], F.col("amount"), "s").select("value", "s")
    assert rows(ours) == rows(plain)


def test_row_numbers_and_previous(hot, sliced):
    w = Window.partitionBy("key").orderBy("amount", "value")
    keys, order = ["key"], ["amount", "value"]
    assert rows(slices.row_numbers(sliced, keys, order, "n").select("value", "n")) == rows(
        hot.select("value", F.row_number().over(w))
    )
    assert rows(slices.previous(sliced, keys, order, "amount", "p").select("value", "p")) == rows(
        hot.select("value", F.lag("amount").over(w))
    )


def test_previous_carries_a_null_value(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i) for i in range(50)], "i int, v int")
    ours = slices.previous(slices.ordered_slices(df, [], ["i"], 7), [], ["i"], "v", "p").select("i", "p")
    assert rows(ours) == rows(df.select("i", F.lag("v").over(Window.orderBy("i"))))


def test_ranks_with_many_ties(hot):
    w = Window.partitionBy("key").orderBy(F.desc("amount"))
    ours = slices.ranks(hot, ["key"], "amount", "r", 8).select("value", "r")
    assert rows(ours) == rows(hot.select("value", F.rank().over(w)))


def test_null_keys_and_values_stay(spark):
    data = [(None if i % 2 else "a", i, None if i % 5 == 0 else i % 4) for i in range(60)]
    df = spark.createDataFrame(data, "k string, i int, v int")
    w = Window.partitionBy("k").orderBy("i")
    sliced = slices.ordered_slices(df, ["k"], ["i"], 6)
    assert rows(slices.running_sum(sliced, ["k"], ["i"], F.col("v"), "s").select("i", "s")) == rows(
        df.select("i", F.sum("v").over(w))
    )
    assert rows(slices.previous(sliced, ["k"], ["i"], "v", "p").select("i", "p")) == rows(df.select("i", F.lag("v").over(w)))
    ranked = slices.ranks(df, ["k"], "v", "r", 6).select("i", "r")
    assert rows(ranked) == rows(df.select("i", F.rank().over(Window.partitionBy("k").orderBy(F.desc("v")))))


@pytest.mark.parametrize("share", [None, 0.5, 1.0])
def test_only_hot_keys_are_sliced(hot, share):
    keys, order = ["key"], ["amount", "value"]
    w = Window.partitionBy("key").orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    falling = Window.partitionBy("key").orderBy(F.desc("amount"))
    plain = hot.select("value", F.sum("amount").over(upto), F.row_number().over(w), F.lag("amount").over(w), F.rank().over(falling))
    found = slices.keyed_sum(hot, keys, order, F.col("amount"), "s", share)
    found = slices.keyed_numbers(found, keys, order, "n", share)
    found = slices.keyed_previous(found, keys, order, "amount", "p", share)
    found = slices.keyed_ranks(found, keys, "amount", "r", share)
    assert found.columns == [*hot.columns, "s", "n", "p", "r"]
    assert rows(found.select("value", "s", "n", "p", "r")) == rows(plain)


def test_keys_that_are_not_hot_take_one_exchange(spark):
    df = spark.range(4000).select((F.col("id") % 1000).alias("k"), "id")
    found = slices.keyed_sum(df, ["k"], ["id"], F.col("id"), "s")
    assert layout.exchange_count(found) == 1
    assert found.count() == 4000


def test_keyed_windows_with_null_keys_and_without_rows(spark):
    data = [(None if i % 2 else f"k{i}", i, None if i % 5 == 0 else i % 4) for i in range(60)]
    df = spark.createDataFrame(data, "k string, i int, v int")
    w = Window.partitionBy("k").orderBy("i")
    found = slices.keyed_previous(slices.keyed_sum(df, ["k"], ["i"], F.col("v"), "s", 0.4), ["k"], ["i"], "v", "p", 0.4)
    assert rows(found.select("i", "s", "p")) == rows(df.select("i", F.sum("v").over(w), F.lag("v").over(w)))
    ranked = slices.keyed_ranks(df, ["k"], "v", "r", 0.4).select("i", "r")
    assert rows(ranked) == rows(df.select("i", F.rank().over(Window.partitionBy("k").orderBy(F.desc("v")))))
    assert slices.keyed_numbers(df.limit(0), ["k"], ["i"], "n").collect() == []


def test_outer_overlap_keeps_rows_without_a_span(spark):
    left = spark.createDataFrame([(1, START, None), (None, START, START), (2, None, None)], "k int, s1 timestamp, e1 timestamp")
    right = spark.createDataFrame([(1, START, START)], "k int, s2 timestamp, e2 timestamp")
    assert intervals.overlap_join(left, right, ["k"], ("s1", "e1"), ("s2", "e2"), 60, "left").count() == 3
    assert intervals.overlap_join(left, right, ["k"], ("s1", "e1"), ("s2", "e2"), 60).count() == 0


def test_volume_aware_layout_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, i) for i in range(5)] + [("a", i) for i in range(3)], "k string, i int")
    assert layout.volume_aware(df, "k", F.col("i"), 0.5, 0.2, 4).count() == 8


def test_chunked_lists_keep_every_row(hot):
    listed = sequences.chunked_lists(hot, ["key"], ["amount", "value"], F.col("value"), 100)
    assert listed.agg(F.max(F.size("sequence"))).first()[0] == 100
    assert listed.filter("key = 'busy'").count() > 20
    back = listed.select("key", F.explode("sequence").alias("value"))
    assert rows(back) == rows(hot.select("key", "value"))


# --------------------------------------------------------------------------------- skew


def test_hot_keys_are_few(hot):
    found = skew.hot_keys(hot, ["key"], 0.1)
    assert rows(found) == [("busy",)]
    share = {k: s for k, _, s, _ in skew.key_shares(hot, ["key"], 0.1).collect()}
    assert 0.75 < share["busy"] < 0.85 and sum(share.values()) == pytest.approx(1)


def test_salted_totals_are_plain_totals(hot):
    found = skew.salted_totals(hot, ["key"], {"s": F.col("amount")}, skew.hot_keys(hot, ["key"], 0.1), ["value"])
    assert rows(found.select("key", "n", "s")) == rows(hot.groupBy("key").agg(F.count("*"), F.sum("amount")))


def test_a_key_that_looks_salted(spark):
    df = spark.createDataFrame([("a_salt_1", 1), ("a", 2)] * 10, "key string, amount int")
    found = skew.salted_totals(df, ["key"], {"s": F.col("amount")}, skew.hot_keys(df, ["key"], 0.1), ["amount"])
    assert rows(found.select("key", "s")) == [("a", 20), ("a_salt_1", 10)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_plain_join(spark, hot, how):
    keys = [("busy", 1), ("busy", 2), *[(f"calm_{i}", i) for i in range(10)], ("other", 0)]
    small = spark.createDataFrame(keys, "key string, d int")
    found = skew.salted_join(hot, small, ["key"], skew.hot_keys(hot, ["key"], 0.1), ["value"], how=how)
    assert rows(found.select("key", "value", "d")) == rows(hot.join(small, "key", how).select("key", "value", "d"))


@pytest.mark.parametrize("salts", [None, 3])
def test_split_join_is_plain_join(spark, hot, salts):
    small = spark.createDataFrame([("busy", 1), ("busy", 2), ("calm_3", 3)], "key string, d int")
    found = skew.hot_key_split_join(hot, small, ["key"], skew.hot_keys(hot, ["key"], 0.1), ["value"], salts)
    assert rows(found.select("key", "value", "d")) == rows(hot.join(small, "key").select("key", "value", "d"))


def test_split_join_follows_the_share_of_a_key(spark, hot):
    small = spark.createDataFrame([("busy", 1), ("busy", 2), ("calm_3", 3), (None, 4)], "key string, d int")
    found = skew.hot_key_split_join(hot, small, ["key"], skew.heavy_hitters(hot, ["key"], 0.1), ["value"], 10)
    assert rows(found.select("key", "value", "d")) == rows(hot.join(small, "key").select("key", "value", "d"))


def test_hot_null_key_is_salted(spark):
    df = spark.createDataFrame([(None if i % 10 else f"k{i}", i) for i in range(100)], "key string, v int")
    hot_keys = skew.hot_keys(df, ["key"], 0.5)
    assert skew.mark_hot(df, ["key"], hot_keys).filter("_hot").count() == 90
    small = spark.createDataFrame([("k10", 1)], "key string, d int")
    found = skew.salted_join(df, small, ["key"], hot_keys, ["v"], how="left")
    assert rows(found.select("key", "v", "d")) == rows(df.join(small, "key", "left").select("key", "v", "d"))


# ---------------------------------------------------------------------------- intervals


def spans(spark, seed, n, names):
    rng = random.Random(seed)
    seen, data = set(), []
    for i in range(n):
        start = START + timedelta(minutes=rng.randrange(0, 3000))
        end = start + timedelta(minutes=rng.choice([0, 1, 30, 60, 500]))
        key = rng.choice([1, 1, 1, 2, 3])
        if (key, start, end) not in seen:
            seen.add((key, start, end))
            data.append((key, i, start, end))
    return data, spark.createDataFrame(data, f"k int, {names[0]} int, {names[1]} timestamp, {names[2]} timestamp")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_overlap_join_against_all_pairs(spark, how):
    a, left = spans(spark, 1, 120, ("a", "s1", "e1"))
    b, right = spans(spark, 2, 120, ("b", "s2", "e2"))
    expected = []
    for k, i, s1, e1 in a:
        hits = [j for kk, j, s2, e2 in b if kk == k and s1 <= e2 and e1 >= s2]
        expected += [(i, j) for j in hits] or ([(i, None)] if how == "left" else [])
    found = intervals.overlap_join(left, right, ["k"], ("s1", "e1"), ("s2", "e2"), 3600, how).select("a", "b")
    assert rows(found) == sorted(expected, key=repr)


def test_tolerance_join_against_all_pairs(spark):
    rng = random.Random(3)
    a = [(rng.choice([1, 1, 2]), i, START + timedelta(seconds=rng.randrange(0, 4000))) for i in range(200)]
    b = [(rng.choice([1, 1, 2]), i, START + timedelta(seconds=rng.randrange(0, 4000))) for i in range(200)]
    b += [(k, 1000 + i, t + timedelta(seconds=120)) for i, (k, _, t) in enumerate(a[:20])]  # exactly at the limit
    expected = []
    for k, i, t in a:
        hits = [j for kk, j, u in b if kk == k and t <= u <= t + timedelta(seconds=120)]
        expected += [(i, j) for j in hits] or [(i, None)]
    left = spark.createDataFrame(a, "ka int, a int, ta timestamp")
    right = spark.createDataFrame(b, "kb int, b int, tb timestamp")
    found = intervals.tolerance_join(left, right, [("ka", "kb")], "ta", "tb", 120, "left").select("a", "b")
    assert rows(found) == sorted(expected, key=repr)


# ----------------------------------------------------------------------------- sessions


def test_sessions_are_session_windows(spark):
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 2]), START + timedelta(seconds=rng.randrange(0, 200_000)), 1) for _ in range(400)]
    data += [(9, START + timedelta(seconds=600 * i), 1) for i in range(5)]  # gaps of exactly the limit
    df = spark.createDataFrame(data, "u int, ts timestamp, v int")
    plain = df.groupBy("u", F.session_window("ts", "10 minutes")).agg(F.count("*").alias("n"), F.sum("v").alias("v"))
    ours = sessions.session_parts(df, "u", "ts", 600, [], {"v": F.col("v")})
    end = F.col("last_time") + F.expr("INTERVAL 10 MINUTES")
    assert rows(ours.select("u", "session_start", end, "n", "v")) == rows(
        plain.select("u", "session_window.start", "session_window.end", "n", "v")
    )


# --------------------------------------------------------------------------------- olap


def test_cube_levels_are_four_groupings(spark):
    df = generate.sales(spark, 500)
    cubed = olap.cube(df, ["region", "category"], {"n": F.lit(1)})
    none = F.lit(None).cast("string")
    parts = [
        df.groupBy("region", "category").count(),
        df.groupBy("region").count().select("region", none, "count"),
        df.groupBy("category").count().select(none, "category", "count"),
        df.groupBy().count().select(none, none, "count"),
    ]
    expected = [r for part in parts for r in rows(part)]
    assert rows(cubed.select("region", "category", "n")) == sorted(expected, key=repr)


def test_null_key_is_not_a_subtotal(spark):
    df = spark.createDataFrame([(None, "a"), ("x", "a")], "r string, c string")
    levels = olap.label_levels(olap.cube(df, ["r", "c"], {"n": F.lit(1)}), {0: "both", 1: "r", 2: "c", 3: "all"}, "level_name")
    found = rows(levels.filter("level_name = 'both'").select("r", "n"))
    assert found == [("x", 1), (None, 1)] or found == [(None, 1), ("x", 1)]
    assert rows(levels.filter("level_name = 'all'").select("n")) == [(2,)]


def test_growth_after_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 5.0), (3, 10.0)], "m int, v double")
    assert [r["growth_rate"] for r in olap.growth(df, "m", "v").orderBy("m").collect()] == [None, None, 100.0]


# ------------------------------------------------------------------------------- layout


def test_partition_sizes_count_empty_partitions(spark):
    df = spark.createDataFrame([(1,)] * 10, "k int").repartition(4, "k")
    assert sorted(r["rows"] for r in layout.partition_sizes(df).collect()) == [0, 0, 0, 10]
    report = layout.partition_report(df, 4).first()
    assert (report["num_partitions"], report["total_records"], report["skew_ratio"], report["assessment"]) == (4, 10, 4.0, "high")


def test_balanced_report(spark):
    report = layout.partition_report(layout.round_robin(spark.range(800), 8), 8).first()
    assert report["assessment"] == "balanced" and report["min_partition_size"] >= 90


def test_report_keeps_partitions_beyond_n(spark):
    report = layout.partition_report(layout.round_robin(spark.range(800), 8), 4).first()
    assert (report.num_partitions, report.total_records) == (8, 800)


def test_overlap_join_with_a_span_that_ends_before_it_starts(spark):
    left = spark.createDataFrame([("a", START, START - timedelta(hours=1)), ("a", START, START)], "k string, s timestamp, e timestamp")
    right = spark.createDataFrame([("a", START, START)], "k string, rs timestamp, re timestamp")
    found = intervals.overlap_join(left, right, ["k"], ("s", "e"), ("rs", "re"), 60)
    assert found.count() == 1


def test_partition_heads(spark):
    heads = layout.partition_heads(layout.by_range(spark.range(100), ["id"], 4), 3)
    assert heads.count() == 12
    assert layout.fewer(heads, 1).rdd.getNumPartitions() == 1


def test_range_layout_keeps_neighbours(spark):
    df = layout.by_range(generate.time_series(spark, 2000), ["date"], 4).withColumn("p", F.spark_partition_id())
    bounds = rows(df.groupBy("p").agg(F.min("date"), F.max("date")))
    assert len(bounds) == 4 and all(a[2] < b[1] for a, b in zip(bounds, bounds[1:]))


def test_spread_splits_a_hot_key(spark, hot):
    plain = layout.by_hash(hot, ["key"], 8).withColumn("p", F.spark_partition_id())
    wide = layout.spread(hot, "key", ["value"], 8).withColumn("p", F.spark_partition_id())
    largest = [df.groupBy("p").count().agg(F.max("count")).first()[0] for df in (plain, wide)]
    assert largest[1] < largest[0] / 2


def test_volume_aware_layout(spark):
    df = generate.mixed_volume(spark)
    laid = layout.volume_aware(df, "pattern_type", F.col("category"), 0.5, 0.2, 8).withColumn("p", F.spark_partition_id())
    parts = {k: n for k, n in rows(laid.groupBy("volume").agg(F.count_distinct("p")))}
    assert parts["low"] == 1 and parts["medium"] <= 4 and parts["high"] >= 6
    assert laid.count() == df.count()


# --------------------------------------------------------------------------------- plans


def test_copartitioned_join_has_one_exchange_per_side(spark):
    # A broadcast would hide the exchanges.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(1000).withColumnRenamed("id", "k")
        right = spark.range(500).withColumnRenamed("id", "k")
        assert layout.exchange_count(joins.copartitioned_join(left, right, "k", 8)) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dimension_join_follows_the_threshold(spark):
    facts = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in layout.explain_text(joins.dimension_join(facts, small, ["k"]), "simple")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in layout.explain_text(joins.dimension_join(facts, small, ["k"]), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in layout.explain_text(joins.merge_join(facts, small, ["k"]), "simple")


def test_generated_rows_repeat(spark):
    assert rows(generate.zipf_like(spark, 300)) == rows(generate.zipf_like(spark, 300))
    counts = [r[1] for r in rows(generate.zipf_like(spark, 5000).groupBy("key").count())]
    assert max(counts) > 5 * min(counts)
    assert generate.region_sales(spark, 400).select("region").distinct().count() == 4
    assert generate.sales(spark, 400).filter("revenue <> quantity * price").count() == 0


def long_spans(spark, rows, names):
    return spark.createDataFrame(rows, f"k string, {names[0]} timestamp, {names[1]} timestamp, {names[2]} long")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_overlaps_of_spans_of_any_length(spark, how):
    """Seconds to millennia, before 1970, ends before starts, nulls: as comparing all pairs has it."""
    rng = random.Random(17)
    start = datetime(2024, 1, 1)

    def some(n, offset):
        out = []
        for i in range(n):
            a = start + timedelta(seconds=rng.choice((rng.randint(0, 600), rng.randint(-10**9, 10**8))), microseconds=rng.choice((0, 1, 999_999)))
            b = a + timedelta(seconds=rng.choice((0, 1, 59, 60, 61, 3600, 86_400 * 365 * 36, -5)))
            out.append((rng.choice("ab"), a, b, offset + i))
        return out + [("a", start, datetime(9999, 1, 1), offset + n), ("b", datetime(1960, 1, 1), datetime(1961, 1, 1), offset + n + 1), ("a", None, start, offset + n + 2), ("a", start, None, offset + n + 3), (None, start, start, offset + n + 4)]

    left, right = some(60, 0), some(60, 1000)
    one, two = long_spans(spark, left, ("ls", "le", "l")), long_spans(spark, right, ("rs", "re", "r"))
    found = intervals.overlap_join(one, two, ["k"], ("ls", "le"), ("rs", "re"), 60, how)
    ok = lambda x: None not in x[:3] and x[1] <= x[2]
    want = [(x[3], y[3]) for x in left for y in right if ok(x) and ok(y) and x[0] == y[0] and x[1] <= y[2] and x[2] >= y[1]]
    if how == "left":
        want += [(x[3], None) for x in left if x[3] not in {a for a, _ in want}]
    assert sorted([(r.l, r.r) for r in found.collect()], key=repr) == sorted(want, key=repr)


def test_dyadic_blocks_make_up_a_span_once(spark):
    rows = spark.createDataFrame([(a, a + n) for a in (-9, -1, 0, 3, 8) for n in (0, 1, 2, 7, 30)] + [(5, 4)], "a long, b long")
    for r in rows.select("a", "b", intervals._cover(F.col("a"), F.col("b"), 6).alias("cover")).collect():
        cells = [c for x in r.cover for c in range(x.block << x.level, (x.block + 1) << x.level)]
        assert sorted(cells) == list(range(r.a, r.b + 1)) and len(r.cover) <= 12


# ------------------------------------------------------------------------------ sketches


def test_heavy_hitters_are_exact(spark):
    data = [("a", i % 7) for i in range(5000)] + [(None, 1)] * 3000 + [(f"k{i}", i) for i in range(4000)] + [("b", 1)] * 1199 + [("c", 1)] * 1200
    df = spark.createDataFrame(data, "k string, v long").repartition(8)
    total = len(data)
    found = {r.k: (r.n, r.share) for r in skew.heavy_hitters(df, ["k"], 1200 / total).collect()}
    assert found == {"a": (5000, 5000 / total), None: (3000, 3000 / total), "c": (1200, 1200 / total)}
    two = {(r.k, r.v): r.n for r in skew.heavy_hitters(df, ["k", "v"], 0.04).collect()}
    assert two == {("a", v): 5000 // 7 + (v < 5000 % 7) for v in range(7)} | {(None, 1): 3000, ("b", 1): 1199, ("c", 1): 1200}
    assert skew.heavy_hitters(df.limit(0), ["k"], 0.1).count() == 0
    with pytest.raises(ValueError, match="share"):
        skew.heavy_hitters(df, ["k"], 0.0)


def test_heavy_hitters_shuffle_candidates_only(spark):
    df = spark.createDataFrame([(i % 3 if i % 2 else i,) for i in range(20_000)], "k long").repartition(8)
    found = skew.heavy_hitters(df, ["k"], 0.1)
    assert "IN" in layout.explain_text(found, "simple").upper() and {r.k for r in found.collect()} == {0, 1, 2}


def test_sketches_unite_to_coarser_periods(spark):
    rows_ = [(START + timedelta(minutes=m), m % 2, (m * 7919) % 500) for m in range(3000)] + [(None, 0, 1), (START, 0, None)]
    df = spark.createDataFrame(rows_, "ts timestamp, k long, u long")
    hours = sketches.distinct_sketches(df, F.date_trunc("hour", "ts"), ["k"], "u").cache()
    days = sketches.united(hours, F.to_date("period"), ["k"])
    got = {(r.period, r.k): (r.rows, r.parts, r.users) for r in days.select("*", sketches.estimate().alias("users")).collect()}
    want = {}
    for ts, k, u in rows_:
        if ts:
            want.setdefault((ts.date(), k), []).append((ts.hour, u))
    assert got.keys() == want.keys()
    for key, seen in want.items():
        users = {u for _, u in seen} - {None}
        assert got[key][:2] == (len(seen), len({h for h, _ in seen})) and abs(got[key][2] - len(users)) <= 0.05 * len(users) + 1


def test_range_layout_skips_row_groups(spark, tmp_path):
    path = str(tmp_path / "laid")
    df = spark.range(40_000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("day"), "id")
    layout.write_ranges(df, ["day"], 8, path)
    groups = [
        pq.ParquetFile(f).metadata.row_group(i).column(0).statistics
        for f in (tmp_path / "laid").glob("*.parquet") for i in range(pq.ParquetFile(f).metadata.num_row_groups)
    ]
    assert len(groups) >= 8 and sum(g.min <= 130 and g.max >= 100 for g in groups) <= 2
    some = spark.read.parquet(path).filter("day between 100 and 130")
    assert "PushedFilters: [IsNotNull(day), GreaterThanOrEqual(day,100)" in layout.explain_text(some, "formatted")
    assert some.count() == df.filter("day between 100 and 130").count()
