"""Every registered query equals its DuckDB oracle on the sf0.01 tables."""

import pytest

from compare import compare
from ledgerline.registry import ORACLE, QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, duck_con, name):
    problems, rows = compare(QUERIES[name](spark, sf), duck_con, ORACLE[name])
    assert not problems, problems
    assert rows > 0


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(entry.queries())  # an optional subpackage may add to them
    assert set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def small_duck():
    from compare import duck

    return duck("/root/testdata/sf0.001")


def _naive_hash(pdf):
    import hashlib

    import pandas as pd

    pdf = pdf[sorted(pdf.columns)]
    rows = sorted("|".join("None" if (v is None or v is pd.NaT or (isinstance(v, float) and v != v)) else str(v)
                           for v in r) for r in pdf.itertuples(index=False))
    return hashlib.md5("\n".join(rows).encode()).hexdigest(), len(rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_types_pair_up_and_strict_hash_matches(spark, small_duck, name):
    """Same column names and type family on both engines, and the strictest
    form of the gate: toPandas() vs DuckDB .df(), every value hashed as str()
    without rounding or date normalisation (sf0.001)."""
    df = QUERIES[name](spark, "/root/testdata/sf0.001")
    rel = small_duck.sql(ORACLE[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    assert _naive_hash(df.toPandas()) == _naive_hash(small_duck.sql(ORACLE[name]).df())
