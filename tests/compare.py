"""Compare a Spark result with its DuckDB twin, column by column and row by row."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
INTEGERS = {"TINYINT", "SMALLINT", "INTEGER", "BIGINT", "HUGEINT"}
SPARK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return None if value is None else str(value)


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([_cell(r[i]) for i in order] for r in rows), key=lambda r: [c or "" for c in r])


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Human-readable differences; empty when both sides agree exactly."""
    found = []
    twin = con.execute(sql)
    columns = [d[0] for d in twin.description]
    types = dict(zip(columns, [str(d[1]) for d in twin.description]))
    theirs = twin.fetchall()
    if sorted(columns) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(columns)}"]
    for name, kind in df.dtypes:
        want, got = SPARK_TYPES.get(kind, kind), types[name]
        if want != got and not (want in INTEGERS and got in INTEGERS):
            found.append(f"type of {name}: {want} != {got}")
    ours = df.collect()
    if len(ours) != len(theirs):
        return [*found, f"rows {len(ours)} != {len(theirs)}"]
    a, b = _sorted_rows(df.columns, ours), _sorted_rows(columns, theirs)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        found.append(f"{len(bad)} of {len(a)} rows differ, first: {bad[0]}")
    return found
