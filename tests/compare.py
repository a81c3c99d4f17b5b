"""Run a registered query and its SQL in DuckDB, and compare rows, names and values."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, Decimal):
        return value.normalize()
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


def differences(frame, con, sql: str) -> str | None:
    """``None`` where both agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    actual = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if len(expected) != len(actual):
        return f"{len(actual)} rows against {len(expected)}"
    for got, want in zip(actual, expected):
        if got != want:
            return f"{got} against {want}"
    return None
