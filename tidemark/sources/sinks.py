"""Bounded sinks."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DateType, DecimalType, MapType, StructType, TimestampNTZType, TimestampType,
)


def write_parquet(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "error") -> None:
    """One directory per value of ``by``.

    ``rebalance`` gathers the rows of a value into few files, and lets the adaptive planner
    split a value that holds far more rows than the others.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> None:
    """External table bucketed and sorted by ``key``; later joins on it need no exchange.

    Hashing to as many partitions as buckets first makes one file per bucket, where every
    task would otherwise write a file to every bucket. Aggregate very hot keys beforehand.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def bucketed(df: DataFrame, key: str, buckets: int, path: str) -> DataFrame:
    """``df`` stored by buckets of ``key`` at ``path``, as a frame for this session.

    Only a table of the catalog can say how files are bucketed. The frame keeps that knowledge, so the
    table's entry goes at once and no names pile up; the files stay.
    """
    table = f"bucketed_{uuid4().hex}"
    write_bucketed(df, table, key, buckets, path)
    stored = df.sparkSession.table(table)
    df.sparkSession.sql(f"DROP TABLE {table}")
    return stored


def _plain(c: Column, kind: DataType) -> Column:
    """Decimals as text, dates and times as ISO text, at any depth."""
    if isinstance(kind, (DecimalType, DateType)):
        return c.cast("string")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        # As Python writes them: a fraction only where there is one.
        return F.regexp_replace(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")
    if isinstance(kind, StructType):
        return F.when(c.isNotNull(), F.struct(*[_plain(c[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: _plain(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(c, lambda _, x: _plain(x, kind.valueType))
    return c


def as_json(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One JSON text per row; decimals become strings so no digit is lost, dates and times ISO text, inside nested values too."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    packed = [_plain(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in fields]
    return df.select(F.to_json(F.struct(*packed), {"ignoreNullFields": "false"}).alias("json"))
