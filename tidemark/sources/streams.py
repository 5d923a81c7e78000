"""Unbounded sources.

No socket source is used: text lines are read from files that appear in a directory.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from tidemark.functions.times import instant


def _reader(spark: SparkSession, files_per_batch: int | None, bytes_per_batch: str | None = None) -> DataStreamReader:
    """All files at once, or a bounded number or size (such as ``10g``) per batch, not both.

    With a bound, files are taken oldest first: rows that an old file holds far behind the
    newest time seen so far count as late. Set it for files that arrive in time order.
    """
    reader = spark.readStream
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader


def csv_stream(
    spark: SparkSession, directory: str, schema: StructType, files_per_batch: int | None = None
) -> DataFrame:
    """CSV files that arrive in a directory; headers are checked against the schema."""
    reader = _reader(spark, files_per_batch).option("header", "true").option("enforceSchema", "false")
    return reader.schema(schema).csv(directory)


def text_stream(spark: SparkSession, directory: str) -> DataFrame:
    return spark.readStream.text(directory)


def table_stream(
    spark: SparkSession, directory: str, name: str, files_per_batch: int | None = None, bytes_per_batch: str | None = None
) -> DataFrame:
    """Replay a parquet table as a stream: ``name`` is one file or a folder of files.

    The bracket makes the path a pattern, which the file source accepts for both forms.
    """
    schema = spark.read.parquet(f"{directory}/{name}.parquet").schema
    pattern = f"{directory}/{name[:-1]}[{name[-1]}].parquet"
    stream = _reader(spark, files_per_batch, bytes_per_batch).schema(schema).parquet(pattern)
    times = [f.name for f in schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return stream.withColumns({c: instant(c) for c in times})


def rate_stream(spark: SparkSession, rows_per_second: int, columns: Mapping[str, Column]) -> DataFrame:
    """Generated stream; ``columns`` are expressions over ``timestamp`` and ``value``."""
    stream = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return stream.select("timestamp", *[c.alias(name) for name, c in columns.items()])


def cycle(values: list[str], counter: str = "value") -> Column:
    """The values in turn, by the row counter of a rate stream."""
    options = F.array(*[F.lit(v) for v in values])
    return F.get(options, (F.col(counter) % len(values)).cast("int"))


def kafka_options(servers: str, topic: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, **extra}


def kafka_stream(spark: SparkSession, servers: str, topic: str, **extra: str) -> DataFrame:
    """Kafka topic as a stream; needs the public Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **extra)).load()
