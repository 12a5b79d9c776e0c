"""Run a registered query and its SQL on the same tables and compare all values."""

from __future__ import annotations

import datetime
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return f"{type(value).__name__}:{value}"


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(con, df, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    cursor = con.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected = normal(expected_columns, cursor.fetchall())
    if sorted(df.columns) != sorted(expected_columns):
        return f"columns {sorted(df.columns)} != {sorted(expected_columns)}"
    actual = normal(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)} rows"
    for a, b in zip(actual, expected):
        if a != b:
            return f"{[p for p in zip(sorted(df.columns), a, b) if p[1] != p[2]]}"
    return None
