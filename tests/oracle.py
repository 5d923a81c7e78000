"""Compare registered queries with their SQL: ``python tests/oracle.py [folder] [key ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, Decimal):
        return float(value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark, con, folder: str, key: str, query, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = query(spark, folder)
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = {c[0]: str(c[1]) for c in result.description}
    theirs = rows_of(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if ours != theirs:
        missing, extra = theirs - ours, ours - theirs
        return (
            f"rows {sum(ours.values())} vs {sum(theirs.values())}; missing {sum(missing.values())}"
            f" {list(missing)[:2]}; extra {sum(extra.values())} {list(extra)[:2]}"
        )
    wanted = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP"}
    off = [f"{c}: {t} vs {types[c]}" for c, t in df.dtypes if wanted.get(t) != types[c]]
    return f"TYPES {off}" if off else None


def main() -> None:
    from tidemark.plans import QUERIES, SQL
    from tidemark.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions=os.environ.get("PARTITIONS", "8"), spark__ui__enabled="false", spark__driver__memory="12g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for key in sys.argv[2:] or list(QUERIES):
        start = time.time()
        try:
            if key in SQL:
                bad = compare(spark, con, folder, key, QUERIES[key], SQL[key])
            else:
                bad = None if QUERIES[key](spark, folder).count() else "no rows"
        except Exception as error:  # noqa: BLE001
            bad = f"{type(error).__name__}: {str(error)[:700]}"
        print(f"{'ok  ' if bad is None else 'FAIL'} {key} {time.time() - start:.1f}s {bad or ''}", flush=True)


if __name__ == "__main__":
    main()
