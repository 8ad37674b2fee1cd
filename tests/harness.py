"""Run a registered query and its oracle, and compare whole results."""

from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return names, sorted(table, key=repr)


def spark_result(df):
    return normal(df.columns, [tuple(row) for row in df.collect()])


def oracle_result(con, sql):
    cursor = con.execute(sql)
    return normal([d[0] for d in cursor.description], cursor.fetchall())


def difference(actual, expected) -> str | None:
    """None when equal, otherwise the first thing that differs."""
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if len(actual[1]) != len(expected[1]):
        return f"rows {len(actual[1])} != {len(expected[1])}"
    for a, e in zip(actual[1], expected[1]):
        if a != e or [type(x) for x in a] != [type(x) for x in e]:
            return f"{a}\n   != {e}"
    return None
