"""Compare a Spark result with a DuckDB statement on the same tables."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(cell(v) for v in value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(cell(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0)
                                           for v in r))


KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def mismatch(df, con, sql: str, want_rows: bool = True) -> str | None:
    """What differs, or None.  Compares names, types, row count and every value."""
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in cur.description}
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {df.columns} vs {names}"
    if dict(df.dtypes) != kinds:
        return f"types {set(df.dtypes) ^ set(kinds.items())}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    if want_rows and not want:
        return "no rows to compare"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]} ({sorted(names)})" if bad else None
