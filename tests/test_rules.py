"""Unit tests of the rule columns on tiny frames (one per rule table)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.functions import department, direction, keep, net_price, not_blank, not_in, not_like, province
from ledgerline.functions.geo import PROVINCE_BY_PREFIX
from ledgerline.functions.tax import TAX_TIERS, asymmetric_tiers
from ledgerline.functions.rules import effective_rate


def _one(spark, rows, schema, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


@pytest.mark.parametrize("scene,price,goods,service", TAX_TIERS)
def test_every_tax_tier(spark, scene, price, goods, service):
    df = spark.createDataFrame([(L.BUS, scene, price)], "segment string, scene string, price int")
    got = df.select(net_price(F.col("segment"), F.col("scene"), F.col("price"))).first()[0]
    want = (Decimal(goods) / Decimal("1.13")).quantize(Decimal("0.000001")) + \
        (Decimal(service) / Decimal("1.06")).quantize(Decimal("0.000001"))
    assert got == want


def test_tax_fallbacks(spark):
    rows = [(L.BUS, L.NEW_PAID, 100), (L.BUS, L.PREPAID, 5), (L.BUS, L.PREPAID, None), (L.TRUCK, L.SIGNING, 80),
            (L.BUS, "other", 80), (L.BUS, L.NEW_PAID, None)]
    df = spark.createDataFrame(rows, "segment string, scene string, price int")
    got = [r[0] for r in df.select(net_price(F.col("segment"), F.col("scene"), F.col("price"))).collect()]
    assert got == [Decimal("94.339623"), Decimal("68.867925"), Decimal("68.867925"), Decimal(0), Decimal(0), Decimal(0)]


def test_asymmetric_tier_lint_reports_195():
    assert asymmetric_tiers() == [(L.SIGNING, 195)]


def test_every_province_prefix_and_fallback(spark):
    ids = [p + "123" for p in PROVINCE_BY_PREFIX] + ["99123", None, "4"]
    got = _one(spark, [(i,) for i in ids], "id string", province(F.col("id")))
    assert got == list(PROVINCE_BY_PREFIX.values()) + [L.OTHER, L.OTHER, L.OTHER]


def test_department_rule_order(spark):
    rows = [
        (L.BUS, L.NEW_PAID, True, "smart_etc_1"),   # rule 1 wins over channel and name
        (L.BUS, L.SIGNING, True, "smart_etc_1"),    # channel before smart name
        (L.BUS, L.SIGNING, False, "x smart_etc y"),
        (L.BUS, L.SIGNING, False, "plain"),
        (L.BUS, None, False, "smart_etc"),          # NULL scene skips rule 1
        (L.TRUCK, L.SIGNING, True, "smart_etc"),
        (None, L.SIGNING, True, None),
    ]
    df = spark.createDataFrame(rows, "segment string, scene string, ch boolean, name string")
    got = [r[0] for r in df.select(department(F.col("segment"), F.col("scene"), F.col("ch"), F.col("name"))).collect()]
    assert got == [L.DEPT_ETC, L.DEPT_LIVE, L.DEPT_SMART, L.DEPT_ETC, L.DEPT_SMART, L.DEPT_DATA, None]


def test_case_predicate_keeps_null(spark):
    df = spark.createDataFrame([("a test",), ("agent",), (None,)], "agent string")
    rule = keep([(F.col("agent").like("%test%"), False)])
    assert [r[0] for r in df.where(rule).collect()] == ["agent", None]


def test_not_in_null_handling(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert sorted(r[0] for r in df.where(not_in(F.col("x"), ["a"])).collect()) == ["b"]
    assert [r[0] for r in df.where(not_in(F.col("x"), ["a"], keep_null=True)).collect()] == ["b", None]
    assert [r[0] for r in df.where(not_like(F.col("x"), "%a%")).collect()] == ["b", None]


def test_not_blank(spark):
    df = spark.createDataFrame([("a",), (" ",), ("",), (None,)], "x string")
    assert [r[0] for r in df.where(not_blank(F.col("x"))).collect()] == ["a"]


def test_direction(spark):
    got = _one(spark, [(5,), (-5,), (0,), (None,)], "x int", direction(F.col("x"), "up", "down"))
    assert got == ["up", "down", None, None]


def test_effective_rate_includes_cut_day(spark):
    from datetime import date
    df = spark.createDataFrame([("2021-03-31",), ("2021-04-01",), ("2021-04-01 10:00:00",)], "d string")
    got = [r[0] for r in df.select(effective_rate(F.col("d"), date(2021, 4, 1), F.lit(1), F.lit(2))).collect()]
    assert got == [1, 2, 2]
