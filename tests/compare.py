"""Compare a Spark result with DuckDB's, row by row in any order."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return str(value)


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    got, want = _rows(df.columns, df.collect()), _rows(names, expected)
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows against {sum(want.values())} of columns {sorted(names)}\n"
        f"only Spark: {list((got - want).items())[:3]}\nonly SQL: {list((want - got).items())[:3]}"
    )
