"""Reproduce the correctness gate locally: entry(), then every queries()
callable against its oracle_sql() in DuckDB (rounding compare and the strict
toPandas()/.df() string hash).

usage: python tools/check.py [SF_DIR] [name,name,...]
"""

from __future__ import annotations

import hashlib
import importlib.util
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tests"))


def strict_hash(pdf):
    import pandas as pd

    pdf = pdf[sorted(pdf.columns)]
    rows = sorted("|".join("None" if (v is None or v is pd.NaT or (isinstance(v, float) and v != v)) else str(v)
                           for v in r) for r in pdf.itertuples(index=False))
    return hashlib.md5("\n".join(rows).encode()).hexdigest(), len(rows)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2].split(",") if len(sys.argv) > 2 else None
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)

    from pyspark.sql import SparkSession

    from compare import compare, duck

    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    t = time.time()
    print(f"entry: {len(entry.entry(spark).collect())} rows, {time.time() - t:.1f}s")
    queries, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    names = only or list(queries)
    for name in names:
        t = time.time()
        df = queries[name](spark, sf_dir)
        problems, rows = compare(df, con, oracles[name])
        if not problems and strict_hash(df.toPandas()) != strict_hash(con.sql(oracles[name]).df()):
            problems = ["strict hash differs"]
        bad += bool(problems)
        print(f"{name:32s} rows={rows:8d} {time.time() - t:5.1f}s {'OK' if not problems else problems}")
    print(f"{len(names)} checked of {len(queries)} queries ({len(oracles)} oracles), {bad} mismatches")


if __name__ == "__main__":
    main()
