"""Comparison of Spark results with DuckDB over the same Parquet files."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# DuckDB type -> Spark type
SAME_TYPE = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(folder) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canonical(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and values agree."""
    relation = con.sql(sql)
    wanted = dict(zip(relation.columns, [str(x) for x in relation.types]))
    have = dict(df.dtypes)
    problems = []
    if set(wanted) != set(have):
        return [f"columns {sorted(have)} but expected {sorted(wanted)}"]
    for name, kind in wanted.items():
        if SAME_TYPE.get(kind, kind) != have[name]:
            problems.append(f"{name}: {have[name]} but expected {kind}")
    left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    right = rows_of(relation.columns, relation.fetchall())
    if len(left) != len(right):
        problems.append(f"{len(left)} rows but expected {len(right)}")
    elif left != right:
        wrong = [(a, b) for a, b in zip(left, right) if a != b]
        problems.append(f"{len(wrong)} of {len(left)} rows differ, e.g. {wrong[0]}")
    return problems
