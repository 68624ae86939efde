"""Decision tables: compiled rules equal the coded form, and reports find planted faults."""

import itertools

import pytest
from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.functions import decision as D
from ledgerline.functions.department import DEPARTMENT_ROWS, department
from ledgerline.functions.rules import keep

AUDIT = [
    ("decreases", 1, "data_type", "=", L.ADJUSTMENT, "keep"), ("decreases", 1, "adjust_type", "=", L.DECREASE, "keep"),
    ("device", 2, "obu_id", "=", "4400000017", "drop"), ("bank", 3, "buyer", "=", "bank_b", "drop"), ("bank", 3, "price", ">", "0", "drop"),
]


def test_department_table_equals_the_coded_rules(spark):
    rows = list(itertools.product((L.BUS, L.TRUCK, "x", None), (L.SIGNING, L.NEW_PAID, None), (True, False, None), ("a smart_etc b", "plain", None)))
    df = spark.createDataFrame(rows, "segment string, scene string, in_channel boolean, open_name string")
    rules = D.rules_of(spark.createDataFrame(DEPARTMENT_ROWS, D.ROW_SCHEMA))  # from a table
    c = {n: F.col(n) for n in df.columns}
    got = df.select(D.decide(rules, c).alias("a"), department(c["segment"], c["scene"], c["in_channel"], c["open_name"]).alias("b")).collect()
    assert len(got) == len(rows) and all(r["a"] == r["b"] for r in got)
    assert {r["a"] for r in got} == {L.DEPT_ETC, L.DEPT_LIVE, L.DEPT_SMART, L.DEPT_DATA, None}


def test_keep_and_drop_table_equals_the_coded_rules(spark):
    rows = list(itertools.product((L.ADJUSTMENT, "r", None), (L.DECREASE, "i"), ("4400000017", "d", None), ("bank_b", None), (1, -1, None)))
    df = spark.createDataFrame(rows, "data_type string, adjust_type string, obu_id string, buyer string, price int")
    c = {n: F.col(n) for n in df.columns}
    coded = keep([((c["data_type"] == L.ADJUSTMENT) & (c["adjust_type"] == L.DECREASE), True), (c["obu_id"] == "4400000017", False),
                  ((c["buyer"] == "bank_b") & (c["price"] > 0), False)])
    got = df.select(D.keeps(D.rules_of(AUDIT), c).alias("a"), coded.alias("b")).collect()
    assert all(r["a"] == r["b"] for r in got) and {r["a"] for r in got} == {True, False}


def test_unreachable_and_asymmetric_rules_are_reported():
    assert D.unreachable(D.rules_of(DEPARTMENT_ROWS)) == []
    faulty = DEPARTMENT_ROWS + [("late", 60, "segment", "=", L.BUS, "x"), ("late", 60, "scene", "=", "y", "x")]
    assert D.unreachable(D.rules_of(faulty)) == [("late", "paid")]
    assert D.unreachable(D.rules_of([("any", 1, None, None, None, "a"), ("b", 2, "k", "=", "v", "b")])) == [("b", "any")]
    tax = [("a", 1, "price", "=", "80", "2.5"), ("b", 2, "price", "=", "-80", "-2.5"), ("c", 3, "price", "=", "70", "2"), ("c", 3, "scene", "=", "s", "2"),
           ("d", 4, "price", "=", "-70", "-2"), ("e", 5, "price", "=", "5", "1"), ("f", 6, "price", "=", "-5", "-3")]
    assert D.asymmetric(D.rules_of(tax), "price") == ["c", "d", "e", "f"]
    for bad in ([("a", 1, "x", "~", "1", "r")], [("a", 1, "x", "=", "1", "r"), ("a", 2, "y", "=", "1", "r")], [("a", 1, "x", "=", "1", "r"), ("b", 1, "x", "=", "2", "r")]):
        with pytest.raises(ValueError):
            D.rules_of(bad)
