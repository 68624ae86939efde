"""Property tests (hypothesis): rule semantics with NULLs against a Python
model, conform is idempotent, union order does not matter."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions.rules import keep, ordered_rule
from ledgerline.operators.feeds import union_feeds
from ledgerline.schema import LEDGER, conform

maybe_int = st.one_of(st.none(), st.integers(min_value=-3, max_value=3))
rows_strategy = st.lists(st.tuples(maybe_int, maybe_int), min_size=1, max_size=30)


def _case(row, rules, default):
    """SQL CASE: a NULL condition does not match."""
    for cond, value in rules:
        c = cond(row)
        if c is True:
            return value
    return default


@settings(max_examples=12, deadline=None)
@given(rows=rows_strategy, t1=st.integers(-3, 3), t2=st.integers(-3, 3))
def test_keep_matches_case_semantics(spark, rows, t1, t2):
    df = spark.createDataFrame(rows, "a int, b int")
    rule = keep([(F.col("a") > t1, False), (F.col("b") < t2, True), (F.col("a") == F.col("b"), False)])
    got = sorted(((r["a"], r["b"]) for r in df.where(rule).collect()), key=repr)
    model_rules = [
        (lambda r: None if r[0] is None else r[0] > t1, 0),
        (lambda r: None if r[1] is None else r[1] < t2, 1),
        (lambda r: None if r[0] is None or r[1] is None else r[0] == r[1], 0),
    ]
    want = sorted((r for r in rows if _case(r, model_rules, 1) == 1), key=repr)
    assert got == want


@settings(max_examples=12, deadline=None)
@given(rows=rows_strategy)
def test_ordered_rule_without_default_is_null(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int")
    col = ordered_rule([(F.col("a") > 0, "pos"), (F.col("b") > 0, "b")], has_default=False)
    got = [r[0] for r in df.select(col).collect()]
    want = [_case(r, [(lambda r: None if r[0] is None else r[0] > 0, "pos"),
                      (lambda r: None if r[1] is None else r[1] > 0, "b")], None) for r in rows]
    assert got == want


ledger_rows = st.lists(st.tuples(
    st.sampled_from(["2001-07-01", "2001-07-02", "2001-08-01"]), st.sampled_from(["signing", "new_paid", None]),
    st.integers(-200, 200), st.one_of(st.none(), st.sampled_from(["44001", "45002"]))), min_size=1, max_size=20)


@settings(max_examples=8, deadline=None)
@given(rows=ledger_rows, seed=st.integers(0, 1000))
def test_conform_idempotent_and_union_order_free(spark, rows, seed):
    df = spark.createDataFrame(rows, "d string, scene string, price int, obu string")
    values = {"date": F.col("d"), "scene": F.col("scene"), "price": F.col("price"), "obu_id": F.col("obu"),
              "segment": "bus", "data_type": "receivable"}
    once = conform(df, values, LEDGER)
    twice = conform(once, {n: f"@{n}" for n in LEDGER.fieldNames()}, LEDGER)
    assert [(f.name, f.dataType) for f in once.schema] == [(f.name, f.dataType) for f in LEDGER]
    assert [(f.name, f.dataType) for f in twice.schema] == [(f.name, f.dataType) for f in LEDGER]
    a = sorted(map(tuple, once.collect()), key=repr)
    assert a == sorted(map(tuple, twice.collect()), key=repr)
    parts = [once.where(F.col("scene") == s) for s in ("signing", "new_paid")] + [once.where(F.col("scene").isNull())]
    random.Random(seed).shuffle(parts)
    assert sorted(map(tuple, union_feeds(parts).collect()), key=repr) == a
