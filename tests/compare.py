"""Compare a Spark result with the DuckDB result of the same query."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def _sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=_sort_key)


def differences(spark_df, con: duckdb.DuckDBPyConnection, statement: str) -> list[str]:
    """What differs in columns, row count and values; empty if the results are equal."""
    left_cols, left = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    result = con.execute(statement)
    names = [c[0] for c in result.description]
    right_cols, right = rows_of(names, result.fetchall())
    if left_cols != right_cols:
        return [f"columns {left_cols} against {right_cols}"]
    found = []
    if len(left) != len(right):
        found.append(f"{len(left)} rows against {len(right)}")
    in_left, in_right = set(left), set(right)
    only_left = [r for r in left if r not in in_right]
    only_right = [r for r in right if r not in in_left]
    for a, b in list(zip(only_left, only_right, strict=False))[:3]:
        parts = [f"{c}: {x!r} / {y!r}" for c, x, y in zip(left_cols, a, b, strict=True) if x != y]
        found.append(f"{len(only_left)} differ, such as {dict(zip(left_cols, a))}: {', '.join(parts)}")
    if not found and (only_left or only_right):
        found.append(f"only left {only_left[:2]}, only right {only_right[:2]}")
    return found
