"""Run catalogue queries against DuckDB: rows, columns and values, order ignored."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(out, key=repr)


def difference(df, con, sql) -> str | None:
    """None if equal, else what differs."""
    got_columns, got = table(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    want_columns, want = table([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns: only here {set(got_columns) - set(want_columns)}, only there {set(want_columns) - set(got_columns)}"
    if got != want:
        here, there = set(map(repr, got)) - set(map(repr, want)), set(map(repr, want)) - set(map(repr, got))
        return (
            f"rows {len(got)} vs {len(want)}; {len(here)} only here, {len(there)} only there; {got_columns}\n"
            f"  here {sorted(here)[:2]}\n  there {sorted(there)[:2]}"
        )
    return None
