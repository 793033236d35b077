"""Small random frames, and the same change done row by row in DuckDB."""

from __future__ import annotations

import random
from collections import Counter

import duckdb
import pyarrow as pa

from tablewright import Limits

# Every physical form: measured and broadcast, shuffled, frequent keys apart.
FORMS = {
    "small": Limits(),
    "shuffled": Limits(broadcast_rows=0, literal_values=0, hot_share=0.99),
    "hot": Limits(broadcast_rows=0, literal_values=0, hot_share=0.02),
}

ARROW = {
    "bigint": pa.int64(),
    "string": pa.string(),
    "date": pa.date32(),
    "timestamp_ntz": pa.timestamp("us"),
    "boolean": pa.bool_(),
}


def spark_frame(spark, columns, rows):
    """``columns`` as ``"k bigint, v string"``."""
    return spark.createDataFrame(rows, columns)


def arrow_table(columns, rows):
    fields = [part.split() for part in columns.split(",")]
    arrays = [
        pa.array([row[i] for row in rows], type=ARROW[kind]) for i, (_, kind) in enumerate(fields)
    ]
    return pa.table(arrays, names=[name for name, _ in fields])


def duck(tables, statements, result="SELECT * FROM t"):
    """Run statements on tables ``{name: (columns, rows)}`` and read the result."""
    con = duckdb.connect()
    for name, (columns, rows) in tables.items():
        data = arrow_table(columns, rows)
        con.register("data", data)
        con.execute(f"CREATE TABLE {name} AS SELECT * FROM data")
        con.unregister("data")
    for statement in statements:
        con.execute(statement)
    return Counter(con.execute(result).fetchall())


def collected(df):
    return Counter(tuple(row) for row in df.collect())


def keyed_rows(seed, count, unique=False, keys=12, nulls=True, hot=0.4):
    """Rows ``(k, j, v, w)`` with NULLs and one frequent key."""
    rng = random.Random(seed)
    rows, seen = [], set()
    for i in range(count):
        k = 1 if rng.random() < hot else rng.randrange(keys)
        j = rng.choice(["a", "b", "é'\\"])
        if nulls and rng.random() < 0.2:
            k = None
        if nulls and rng.random() < 0.1:
            j = None
        if unique and None not in (k, j):
            if (k, j) in seen:
                continue
            seen.add((k, j))
        rows.append((k, j, rng.choice([None, i]), rng.choice([None, "x", "y"])))
    return rows


KEYED = "k bigint, j string, v bigint, w string"
