from __future__ import annotations

import json
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.operators import layout
from tidemark.session import SETTINGS, settings_report, shared_folder, using, written
from tidemark.sources import files, generate, sinks, streams
from tests.conftest import rows


@pytest.fixture()
def orders(spark):
    data = [(1, 1, "Pen, blue", 2, Decimal("1.50"), date(2024, 1, 1), "pending"), (2, 1, "Ink", 1, Decimal("9.99"), None, None)]
    return spark.createDataFrame(data, schemas.declared("orders"))


def test_csv_round_trip(spark, orders, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(orders, path)
    assert rows(files.scan_csv(spark, path, schemas.declared("orders"))) == rows(orders)
    assert dict(files.scan_csv_as_text(spark, path).dtypes)["quantity"] == "string"
    assert dict(files.scan_csv_inferred(spark, path).dtypes)["quantity"] == "int"


def test_csv_with_other_columns_fails(spark, orders, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(orders.withColumnRenamed("quantity", "amount"), path)
    with pytest.raises(Exception, match="header does not conform"):
        files.scan_csv(spark, path, schemas.declared("orders")).collect()


def test_rows_to_frame(spark):
    schema = schemas.declared("orders")
    row = {"order_id": 1, "customer_id": 2, "product_name": "Ink", "quantity": 1, "price": Decimal("1.00")}
    assert files.rows_to_frame(spark, [row], schema).first()["status"] is None
    with pytest.raises(ValueError, match="required fields: price"):
        files.rows_to_frame(spark, [{**row, "price": None}], schema)


@pytest.mark.parametrize("write, read", [(sinks.write_parquet, "parquet"), (sinks.write_json, "json")])
def test_write_modes(spark, tmp_path, write, read):
    path, df = str(tmp_path / "out"), spark.range(3)
    write(df, path)
    with pytest.raises(PySparkException):
        write(df, path)
    write(df, path, "ignore")
    write(df, path, "append")
    assert getattr(spark.read, read)(path).count() == 6
    write(df, path, "overwrite")
    assert getattr(spark.read, read)(path).count() == 3


def test_json_text_keeps_decimals(orders):
    first, second = [r[0] for r in sinks.as_json(orders, ["order_id", "price", "order_date"]).collect()]
    assert first == '{"order_id":1,"price":"1.50","order_date":"2024-01-01"}'
    assert second == '{"order_id":2,"price":"9.99","order_date":null}'


def test_partitioned_write_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "regions")
    sinks.write_partitioned(generate.region_sales(spark, 400), path, ["region"])
    coast = files.scan_parquet(spark, path).filter(F.col("region") == "coast")
    assert "PartitionFilters: [isnotnull(region" in layout.explain_text(coast, "simple")
    opened = [r[0] for r in coast.select(F.input_file_name()).distinct().collect()]
    assert opened and all("region=coast" in name for name in opened)


def test_bucketed_join_needs_no_exchange(spark, tmp_path):
    a, b = spark.range(1000).withColumnRenamed("id", "k"), spark.range(300).withColumnRenamed("id", "k")
    for name, df in (("bucket_a", a), ("bucket_b", b)):
        sinks.write_bucketed(df, name, "k", 4, str(tmp_path / name))
    joined = spark.table("bucket_a").join(spark.table("bucket_b").hint("merge"), "k")
    assert layout.exchange_count(joined) == 0
    assert layout.exchange_count(joined.groupBy("k").count()) == 0
    assert joined.count() == 300


def test_bucketed_frames_leave_no_table_behind(spark, tmp_path):
    before = {x.name for x in spark.catalog.listTables()}
    a = sinks.bucketed(spark.range(1000).withColumnRenamed("id", "k"), "k", 4, str(tmp_path / "a"))
    b = sinks.bucketed(spark.range(300).withColumnRenamed("id", "k"), "k", 4, str(tmp_path / "b"))
    joined = a.join(b.hint("merge"), "k")
    assert layout.exchange_count(joined) == 0
    assert joined.count() == 300
    assert {x.name for x in spark.catalog.listTables()} == before


def test_filters_and_columns_reach_the_scan(spark):
    df = files.scan_parquet(spark, "/root/testdata/sf0.001/events.parquet")
    plan = layout.explain_text(df.filter(F.col("event_type").isin("click")).select("user_id"))
    assert "EqualTo(event_type,click)" in plan
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan


def test_written_keeps_rows(spark):
    df = spark.range(10).repartition(3).withColumn("p", F.spark_partition_id())
    assert rows(written(df, "test")) == rows(df)
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_settings(spark):
    report = settings_report(spark)
    assert all(report[k] == v for k, v in SETTINGS.items())
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with using(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_cache_and_release(spark):
    df = spark.range(5).cache()
    assert df.count() == 5 and df.is_cached
    assert not df.unpersist().is_cached


# ------------------------------------------------------------------------------- streams


def test_rate_stream_columns(spark):
    columns = {"user_id": (F.col("value") % 1000).cast("string"), "action": streams.cycle(["click", "view"])}
    df = streams.rate_stream(spark, 50, columns)
    assert df.isStreaming and df.dtypes == [("timestamp", "timestamp"), ("user_id", "string"), ("action", "string")]
    turn = spark.range(4).select(streams.cycle(["a", "b", "c"], "id"))
    assert [r[0] for r in turn.collect()] == ["a", "b", "c", "a"]


def test_kafka_options():
    assert streams.kafka_options("host:9092", "orders", startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "orders", "startingOffsets": "earliest",
    }


# ------------------------------------------------------------------------------- schemas


def test_all_schemas_are_declared():
    assert len(schemas.declared_names()) == 11
    for name in schemas.declared_names():
        assert schemas.declared(name).fields
    assert schemas.for_file_kind("user_activity") == schemas.declared("user_activity_raw")
    assert schemas.for_file_kind("unknown") is None
    assert schemas.declared("nested")["orders"].dataType.elementType["items"].dataType.elementType["price"].nullable is False
    assert "price: decimal(10,2) not null" in schemas.describe(schemas.declared("orders"))


def test_schema_diff(spark):
    found = schemas.diff(schemas.declared("transactions"), schemas.declared("transactions_raw"))
    assert found.type_mismatches == ["event_time: TimestampType() vs StringType()"] and not found.same_types
    found = schemas.diff(schemas.declared("customers"), schemas.declared("live_data"))
    assert "salary" in found.missing_fields and "session_id" in found.extra_fields
    frame = schemas.diff_frame(spark, schemas.declared("transactions"), schemas.declared("transactions_raw"))
    assert rows(frame) == [("type_mismatches", "event_time: TimestampType() vs StringType()")]


def test_match_tests_nulls_on_the_data(spark, orders):
    relaxed = spark.createDataFrame(orders.collect(), "order_id int, customer_id int, product_name string, quantity int,"
                                    " price decimal(10,2), order_date date, status string")
    assert schemas.matches(relaxed, schemas.declared("orders"))
    assert not schemas.matches(relaxed.withColumn("price", F.lit(None).cast("decimal(10,2)")), schemas.declared("orders"))
    assert not schemas.matches(relaxed.drop("price"), schemas.declared("orders"))


def test_conform_reorders_and_casts(spark):
    raw = spark.createDataFrame([("k", 1, datetime(2024, 1, 1), "view", 1)], "session_id string, user_id int, timestamp timestamp, action string, value int")
    typed = schemas.conform(raw, schemas.declared("live_data"))
    assert typed.columns == schemas.declared("live_data").names and dict(typed.dtypes)["value"] == "decimal(10,2)"


def test_exported_records_are_iso_at_any_depth(spark):
    kind = "t timestamp, n timestamp_ntz, d date, s struct<d: decimal(10,2), t: timestamp>, a array<struct<x: decimal(5,1)>>, m map<string, date>, i int"
    rows_ = [
        (datetime(2024, 1, 1), datetime(2024, 1, 2, 3, 4, 5, 600), date(2024, 1, 3), (Decimal("1.50"), None), [(Decimal("2.0"),)], {"k": date(2024, 1, 4)}, 7),
        (None, None, None, None, None, None, None),
    ]
    got = [json.loads(r.json) for r in sinks.as_json(spark.createDataFrame(rows_, kind)).collect()]
    assert got[0] == {
        "t": "2024-01-01T00:00:00", "n": "2024-01-02T03:04:05.000600", "d": "2024-01-03", "s": {"d": "1.50", "t": None}, "a": [{"x": "2.0"}],
        "m": {"k": "2024-01-04"}, "i": 7,
    }
    assert got[1] == dict.fromkeys(got[0])


def test_required_fields_stop_the_job(spark):
    kind = "id bigint, a string, s struct<b: int, c: array<struct<d: int>>>"
    expected = StructType.fromDDL("id bigint not null, a string, s struct<b: int not null, c: array<struct<d: int not null>>>")
    good = [(1, None, (1, [(2,)])), (2, "x", None), (3, "y", (1, None))]
    frame = lambda rows_: schemas.required(spark.createDataFrame(rows_, kind), expected, F.col("id"))
    assert frame(good).count() == 3
    for bad, said in (((None, "x", None), "required field is null: id, row without a name"), ((9, "x", (None, None)), "a member of s, row 9"), ((8, None, (1, [(None,)])), "a member of s, row 8")):
        with pytest.raises(Exception, match=said):
            frame([*good, bad]).count()
    with pytest.raises(ValueError, match="no such columns: a"):
        schemas.required(spark.range(1), StructType.fromDDL("a int not null"), F.col("id"))
