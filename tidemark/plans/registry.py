"""The list of registered queries.

A query is a function ``(spark, folder) -> DataFrame`` that reads the tables below
``folder``. Its key is the function name; ``sql`` is the same query for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql.strip()
        return f

    return register
