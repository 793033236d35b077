"""Compare a Spark result with the same query's result in DuckDB."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    return list(value) if isinstance(value, (list, tuple)) else value


def spark_rows(df) -> tuple[list[str], Counter]:
    order = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    names = [df.columns[i] for i in order]
    table = df.toArrow().to_pydict() if df.columns else {}
    data = zip(*[table[name] for name in names])
    return names, Counter(repr([_plain(v) for v in row]) for row in data)


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    table = con.sql(sql).to_arrow_table()
    names = sorted(table.column_names)
    data = zip(*[table.column(name).to_pylist() for name in names])
    return names, Counter(repr([_plain(v) for v in row]) for row in data)
