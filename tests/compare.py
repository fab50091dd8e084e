"""Spark against DuckDB: same columns, same rows in any order."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(map(plain, v)) + "]"
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str:
    """Empty if the results are the same."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    mine, theirs = rows_of(df.columns, df.collect()), rows_of(names, result.fetchall())
    if mine == theirs:
        return ""
    only = [r for r in mine if r not in set(theirs)][:3], [r for r in theirs if r not in set(mine)][:3]
    return f"{len(mine)} and {len(theirs)} rows; {sorted(df.columns)}; only in Spark {only[0]}; only in DuckDB {only[1]}"
