"""Bounded scans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def scan_csv(spark: SparkSession, path: str, schema: StructType, **options: str) -> DataFrame:
    """CSV with a header and declared types.

    Spark binds CSV columns by position. ``enforceSchema=false`` makes every file's header
    be compared with the schema, so a file with other columns fails instead of shifting.
    """
    reader = spark.read.option("header", "true").option("enforceSchema", "false")
    return reader.options(**options).schema(schema).csv(path)


def scan_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with types found by an extra pass over the data; for exploration only."""
    return spark.read.option("header", "true").option("inferSchema", "true").csv(path)


def scan_csv_as_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header names, every column a string."""
    return spark.read.option("header", "true").csv(path)


def scan_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON object per line, with a declared schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def rows_to_frame(spark: SparkSession, rows: Iterable[Mapping], schema: StructType) -> DataFrame:
    """A small hand-written table under a declared schema.

    Absent keys are nulls; all required fields that some row lacks are named in one error.
    """
    records = list(rows)
    lacking = [f.name for f in schema.fields if not f.nullable and any(r.get(f.name) is None for r in records)]
    if lacking:
        raise ValueError(f"rows lack required fields: {', '.join(lacking)}")
    return spark.createDataFrame([[r.get(name) for name in schema.names] for r in records], schema)
