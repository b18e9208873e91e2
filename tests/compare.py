"""Runs a query and its SQL on the same tables and compares the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return con


def _plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, float):
        return float(f"{x:.9g}")
    if isinstance(x, list | tuple):
        return tuple(map(_plain, x))
    if type(x).__name__ == "Decimal":
        return float(f"{float(x):.9g}")
    if hasattr(x, "isoformat"):
        return x.isoformat().replace("+00:00", "")
    return x


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, query, sql: str, sf_dir: str) -> str:
    """'' if names and rows agree."""
    df = query(spark, sf_dir)
    rel = connect(sf_dir).sql(sql)
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} and {sorted(rel.columns)}"
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(rel.columns, rel.fetchall())
    if mine == theirs:
        return ""
    a, b = set(mine) - set(theirs), set(theirs) - set(mine)
    return f"{len(mine)} and {len(theirs)} rows; only here {list(a)[:3]}, only there {list(b)[:3]}"
