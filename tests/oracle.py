"""Run a query in Spark and its SQL in DuckDB and compare names, types and rows."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark type -> DuckDB type.
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "float": "FLOAT",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.9g}"
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides agree."""
    rel = con.sql(sql)
    ours = {n: TYPES.get(t, t) for n, t in df.dtypes}
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    if ours != theirs:
        return [f"schema: spark {sorted(ours.items())} sql {sorted(theirs.items())}"]
    a, b = _rows(df.columns, df.collect()), _rows(rel.columns, rel.fetchall())
    out = []
    if len(a) != len(b):
        out.append(f"rows: spark {len(a)} sql {len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        out.append(f"only spark ({len(sa - sb)}): {sorted(sa - sb)[:4]}")
        out.append(f"only sql ({len(sb - sa)}): {sorted(sb - sa)[:4]}")
    return out
