from __future__ import annotations

import re

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import numbers, text, times
from tidemark.functions.udfs import upper_batch
from tests.conftest import rows


def mapped(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in sorted(df.select("i", expression(F.col("s"))).collect())]


NAMES = ["o'neil", "MC-DONALD", "3rd street", "  alice johnson  ", "", "straße ßa", "éa ÀB", "a_b c.d", "tab\tname", "x\ue000 yZ \ue000a", "中a b", "a中B あc", "ªb ºC x٣y"]


def test_title_case_is_that_of_python(spark):
    assert mapped(spark, NAMES, text.title_case) == [s.title() for s in NAMES]


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=126), max_size=20), min_size=200, max_size=300))
def test_title_case_and_strip_on_any_ascii(spark, values):
    assert mapped(spark, values, text.title_case) == [s.title() for s in values]
    assert mapped(spark, values, text.strip) == [s.strip() for s in values]


def test_null_text_stays_null(spark):
    assert mapped(spark, [None], text.title_case) == [None]
    assert mapped(spark, [None], text.strip) == [None]


def test_email_is_that_of_python(spark):
    values = ["a@b.co", "a.b-c@d-e.f.org", "a@b", "@b.co", "a b@c.de", "a@b.co\n", "ü@b.co", "a@b.c o", ""]
    assert mapped(spark, values, text.is_email) == [bool(re.fullmatch(text.EMAIL[1:-1], v)) for v in values]


def test_half_even_and_ratio(spark):
    df = spark.sql("SELECT 0 AS zero, 10 AS ten")
    assert rows(df.select(numbers.ratio(F.col("ten"), F.col("zero")), numbers.ratio(F.col("ten"), F.lit(4)))) == [(None, 2.5)]


def test_cents(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (1200.999,), (-5.01,)], "v double")
    cents = numbers.summable(numbers.whole_cents("v"))
    found = df.agg(numbers.cents_total(cents), numbers.cents_mean(cents), numbers.cents_rounded(F.sum(cents), F.lit(3))).first()
    assert tuple(found) == (1196.29, 1196.29 / 4, 398.76)


def test_time_expressions(spark):
    df = spark.sql("SELECT timestamp'2024-01-01 00:03:21' AS a, timestamp'2024-01-01 00:08:22' AS b")
    found = df.select(
        times.arrival_status(F.col("a"), F.col("b"), 300),
        times.arrival_status(F.col("a"), F.col("b"), 301),
        times.seconds_between(F.col("a"), F.col("b")),
        times.epoch_bucket(F.unix_timestamp("a"), 120) % 600,
        times.offset_in(times.epoch_bucket(F.unix_timestamp("a"), 120), 300),
        times.processing_delay(F.col("a")) > 0,
    )
    assert rows(found) == [("LATE", "ON_TIME", 301, 120, 120, True)]


def test_micro_bucket_before_the_epoch(spark):
    df = spark.sql("SELECT timestamp'1969-12-31 23:59:59' AS a")
    assert df.select(times.micro_bucket(F.col("a"), 60)).first()[0] == -60_000_000


def test_upper_batch_keeps_nulls(spark):
    assert mapped(spark, ["aé", None], upper_batch) == ["AÉ", None]
    assert list(upper_batch.func(pd.Series(["a"]))) == ["A"]
