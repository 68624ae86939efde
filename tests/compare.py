"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's gate)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(root, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if isinstance(v, decimal.Decimal):
        return f"{round(float(v), 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.6f}"
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(v, dt.date):
        return v.strftime("%Y-%m-%d") + " 00:00:00"
    return str(v)


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    rows = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in idx) for r in rows)


def compare(spark_df, con, sql):
    sc, sr = spark_rows(spark_df)
    dc, dr = duck_rows(con, sql)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} duck={dc}")
    if len(sr) != len(dr):
        problems.append(f"row count spark={len(sr)} duck={len(dr)}")
    if not problems and sr != dr:
        from collections import Counter
        a, b = Counter(sr), Counter(dr)
        problems.append(f"values differ: only spark {list((a - b).elements())[:3]} only duck {list((b - a).elements())[:3]}")
    return problems, len(sr)
