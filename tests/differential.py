"""Compare registered queries with their SQL on the given tables."""

from __future__ import annotations

import math
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def open_tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v.isoformat() if isinstance(v, datetime) else v


def _sorted(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in records]
    return sorted(plain, key=lambda t: [(v is None, type(v).__name__, str(v)) for v in t])


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "float": "FLOAT",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def difference(df, con, sql: str) -> str | None:
    """None when both sides hold the same rows, otherwise what differs."""
    names = df.columns
    mine = _sorted(names, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    theirs = _sorted(theirs_names, result.fetchall())
    if sorted(names) != sorted(theirs_names):
        return f"columns {sorted(names)} != {sorted(theirs_names)}"
    types = {d[0]: str(d[1]) for d in result.description}
    for name, kind in df.dtypes:
        if SQL_TYPES.get(kind, kind) != types[name]:
            return f"type of {name}: {kind} != {types[name]}"
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None
