"""Malformed hand-loaded rows: kept out of the ledger, with their reasons, without failing."""

import json
import uuid
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.adjustments import admit
from ledgerline.plans import jobs as J
from ledgerline.plans.bus import bus_ledger
from ledgerline.plans.inputs import fixture_inputs
from ledgerline.registry import MONTH_CLOSE
from ledgerline.schema import HAND_LOADED
from ledgerline.session import scratch_path

SMALL = "/root/testdata/sf0.001"
RAW = "date string, scene string, money string, obu_id string, note string"
ROWS = [
    ("2001-07-03", "new_paid", "-5.50", "d1", "fine"), ("2001-07-04", "signing", "12,5", "d2", None), ("03.07.2001", "signing", "abc", "d3", None),
    (None, "signing", "1", "d4", None), ("2001-07-05", "signing", None, None, "nulls that may be"), ("2001-07-06", "signing", "99999999999999999999", "d6", None),
]


def test_admit_splits_rows_and_gives_every_reason(spark):
    schema, required = HAND_LOADED["live_adjustments"]
    found = admit(spark.createDataFrame(ROWS, RAW), "live_adjustments", schema, required)
    good = {r["obu_id"]: r for r in found.good.collect()}
    assert set(good) == {"d1", None} and good["d1"]["money"] == Decimal("-5.50") and good["d1"]["date"] == date(2001, 7, 3) and good["d1"]["note"] == "fine"
    rejects = {json.loads(r["raw"])["obu_id"]: r["reasons"] for r in found.rejects.collect()}
    assert set(rejects) == {"d2", "d3", "d4", "d6"}
    assert rejects["d3"] == ["date: not date: 03.07.2001", "money: not decimal(18,2): abc"] and rejects["d4"] == ["date: missing"]
    empty = admit(spark.createDataFrame([], RAW), "x", schema, required)
    assert empty.good.count() == 0 and empty.rejects.count() == 0
    with pytest.raises(ValueError, match="money"):
        admit(spark.createDataFrame([("a",)], "obu_id string"), "x", schema)


def test_rejected_rows_are_written_per_day_and_stay_out_of_the_ledger(spark):
    inputs = fixture_inputs(spark, SMALL)
    inputs["live_adjustments"] = spark.createDataFrame(ROWS, RAW)
    table = f"rej_{uuid.uuid4().hex[:6]}"
    for _ in range(2):
        checked = J.admit_hand_loaded(inputs, MONTH_CLOSE, table, scratch_path(spark, "rej"))
        assert spark.table(table).groupBy("input", "ds").count().collect()[0][:] == ("live_adjustments", "20010801", 4)
    got = bus_ledger(checked, MONTH_CLOSE).where(F.col("scene2").isin("after_sales_person_decrease", "new_paid_person_decrease") & (F.col("obu_id").isin("d1", "d2", "d3", "d4", "d6") | F.col("obu_id").isNull()))
    mine = {(r["obu_id"], r["price"]) for r in got.collect()}
    assert ("d1", Decimal("-5.50")) in mine and not {k for k, _ in mine} & {"d2", "d3", "d4", "d6"}
