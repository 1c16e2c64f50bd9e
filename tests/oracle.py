"""Run registered queries beside their SQL in DuckDB and compare every value."""

from __future__ import annotations

import datetime
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    return value


def rows(columns, records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in records)


def differences(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short account of the difference."""
    got_columns, got = df.columns, [tuple(r) for r in df.collect()]
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    left, right = rows(got_columns, got), rows(want_columns, want)
    if left == right:
        return None
    only_left, only_right = left - right, right - left
    return (f"rows {len(got)} vs {len(want)}; {sum(only_left.values())} only in Spark e.g. {sorted(map(str, only_left))[:2]}; "
            f"{sum(only_right.values())} only in SQL e.g. {sorted(map(str, only_right))[:2]}; columns {sorted(got_columns)}")
