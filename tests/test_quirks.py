"""One test per kept or fixed quirk."""

from datetime import date

from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.functions.cost import profit
from ledgerline.operators.joins import resolve_id
from ledgerline.plans import cost as C
from ledgerline.plans import services as S
from ledgerline.plans.inputs import fixture_inputs
from ledgerline.registry import MONTH_CLOSE
from ledgerline.sources import fixtures as fx


def test_q8_two_channels_fan_out(spark, sf):
    i = fixture_inputs(spark, sf)
    detail = C.bill_cost_detail(i["bill"], i["bill_lines"], i["settlement"], i["product"])
    per_bill = detail.groupBy("statement_id", "flow").count()
    assert per_bill.where("count = 2").count() > 0
    assert per_bill.where("count > 2").count() == 0


def test_q17_only_late_fee_null_is_zero(spark):
    df = spark.createDataFrame([(10, None, 1, 2), (10, 1, None, 2)], "s int, l int, p int, c int")
    got = [r[0] for r in df.select(profit(F.col("s"), F.col("l"), F.col("p"), F.col("c"))).collect()]
    assert got == [7, None]


def test_q21_parity_mode_merges_equal_refunds(spark, sf):
    detail = fx.fx_detail(spark, sf)
    fixed = S.aftersales_movements(detail, MONTH_CLOSE).where(F.col("adjust_type") == L.DECREASE)
    parity = S.aftersales_movements(detail, MONTH_CLOSE, parity_constant_id=True).where(F.col("adjust_type") == L.DECREASE)
    assert parity.count() <= fixed.count()
    ids = {r[0] for r in parity.where(F.col("data_type") == L.RECEIVED).select("id").collect()}
    assert ids <= {"1"}


def test_q26_unique_resolution_does_not_fan_out(spark):
    base = spark.createDataFrame([("o1", "swap"), ("o2", "keep")], "obu_id string, scene2 string")
    m = spark.createDataFrame([("o1", "d1"), ("o1", "d2"), ("o2", "d3")], "order_id string, device_id string")
    swap = F.col("scene2") == "swap"
    fan = resolve_id(base, m, "obu_id", "order_id", "device_id", when=swap)
    one = resolve_id(base, m, "obu_id", "order_id", "device_id", when=swap, unique=True)
    assert sorted(r[0] for r in fan.collect()) == ["d1", "d2", "o2"]
    assert sorted(r[0] for r in one.collect()) == ["d1", "o2"]


def test_q11_precedence_and_binds_first(spark):
    accounts = spark.createDataFrame(
        [("BZ91", "bank_b", 100), ("91", "bank_b", 1000), ("92", "bank_a", 10000), ("51", "bank_a", 7)],
        "accno string, bank_name string, balance_cents bigint")
    wallet = spark.createDataFrame([(None,)], "wallet_balance decimal(18,2)")
    from ledgerline.context import RunContext
    rows = {r["deposit_kind"]: r["amount"] for r in
            C.deposit_totals(accounts, wallet, RunContext(as_of=date(2001, 1, 2))).collect()}
    assert rows == {"center_bank_deposit": 101.0, "center_online_deposit": 0.07, "wallet_deposit": None}


def test_q14_raw_event_dedup_keeps_same_day_events(spark):
    from datetime import datetime
    from ledgerline.context import RunContext
    from ledgerline.operators.feeds import FeedSpec, build_feed
    rows = [("a", datetime(2001, 7, 3, 9), 80, "20010715"), ("a", datetime(2001, 7, 3, 17), 80, "20010715"),
            ("a", datetime(2001, 7, 3, 17), 80, "20010715")]
    df = spark.createDataFrame(rows, "id string, event_ts timestamp_ntz, price int, ds string")
    ctx = RunContext(as_of=date(2001, 7, 15))
    base = dict(name="f", source="s", event="event_ts", segment=L.BUS, scene2="x", scene=L.SIGNING, buyer="b",
                price=F.col("price"), key=F.col("id"))
    assert build_feed(FeedSpec(**base), df, ctx).count() == 1
    assert build_feed(FeedSpec(**base, dedup_raw_event=True), df, ctx).count() == 2


def test_d9_adjustment_arm_passes_window_and_device_filters(spark, sf):
    detail = fx.fx_detail(spark, sf)
    base = S.other_movements(detail, MONTH_CLOSE)
    adj = spark.createDataFrame(
        [("etc", "upgrade", date(2001, 7, 20), "777", -5.0, "adj1", "20010801", "receivable", "adjustment"),
         ("etc", "upgrade", date(2001, 6, 20), "778", -5.0, "adj2", "20010801", "receivable", "adjustment"),
         ("etc", "upgrade", date(2001, 7, 20), " ", -5.0, "adj3", "20010801", "receivable", "adjustment")],
        "sale_department string, service_scene2 string, date date, obu_id string, price double, id string, "
        "ds string, scene string, data_type string").withColumn("month", F.date_format("date", "yyyy-MM"))
    out = S.other_movements(detail, MONTH_CLOSE, adjustments=adj)
    assert out.count() == base.count() + 1
    assert out.where("id = 'adj1'").count() == 1


def test_q4_strict_refunds_use_refund_state_and_negate(spark, sf):
    eq = fx.fx_equipment(spark, sf)
    kept = {(r["month"], r["type"]): r["money"] for r in S.debit_refund_totals(eq).collect()}
    fixed = {(r["month"], r["type"]): r["money"] for r in S.debit_refund_totals(eq, strict=True).collect()}
    assert {k: v for k, v in kept.items() if k[1] == "debit"} == {k: v for k, v in fixed.items() if k[1] == "debit"}
    assert all(v > 0 for k, v in kept.items() if k[1] == "refund")
    assert all(v < 0 for k, v in fixed.items() if k[1] == "refund")


def test_q6_corrections_of_an_older_month_join_its_rows(spark, sf):
    from decimal import Decimal
    from ledgerline.plans import merge as M
    stray = spark.createDataFrame(
        [("o1", Decimal("5.00"), "2001-07"), ("o1", Decimal("5.00"), "2001-07")], "obu_id string, price decimal(18,2), month string")
    i = fixture_inputs(spark, sf)
    i["adjust_file"] = stray
    lg = i["ledger_table"]
    truck, bus = lg.where(F.col("segment") == L.TRUCK), lg.where(F.col("segment") == L.BUS)
    old = M.ADJUSTMENT_MONTH
    try:
        M.ADJUSTMENT_MONTH = "2001-01"  # an adjustment dated in the window, filed under an old month
        before = i["current_ledger"].where(F.col("month") == "2001-01").count()
        first = M.merge_ledger(spark, i, MONTH_CLOSE, truck, bus)
        assert dict(first.dtypes)["price"] == "decimal(18,2)"
        rows = sorted(map(tuple, first.where(F.col("month") == "2001-01").collect()), key=repr)
        assert before > 0 and sum(r[5] == "o1" for r in rows) == 2 and len(rows) > before
        # a second run on what the first wrote changes nothing
        stored = i["current_ledger"].withColumn(M.ARM, F.lit(None).cast("string"))
        i["current_ledger"] = spark.createDataFrame(rows, M.STORED).unionByName(stored.where(F.col("month") != "2001-01"))
        again = M.merge_ledger(spark, i, MONTH_CLOSE, truck, bus).where(F.col("month") == "2001-01")
        again = sorted(map(tuple, again.collect()), key=repr)
        assert len([r for r in again if r[9] != "q2_bus_bank_first_use"]) == len([r for r in rows if r[9] != "q2_bus_bank_first_use"])
    finally:
        M.ADJUSTMENT_MONTH = old


def test_booked_rows_equal_to_a_late_correction_stay(spark, sf):
    """Two booked rows and one late correction that equals them: three rows, run after run."""
    from datetime import date
    from decimal import Decimal
    from ledgerline.plans import merge as M
    row = (date(2001, 7, 20), L.SIGNING, "bank_b", Decimal("5.00"), None, "dev", L.ADJUSTMENT, L.INCREASE, L.TRUCK, "fix", Decimal("0"), "2001-01")
    i = fixture_inputs(spark, sf)
    i["corrections"] = spark.createDataFrame([row], M.MERGED)
    i["current_ledger"] = spark.createDataFrame([row, row], M.MERGED)
    lg = i["ledger_table"]
    truck, bus = lg.where(F.col("segment") == L.TRUCK), lg.where(F.col("segment") == L.BUS)
    for _ in range(3):
        old = M.merge_ledger(spark, i, MONTH_CLOSE, truck, bus).where(F.col("month") == "2001-01").collect()
        assert len(old) == 3 and sorted(r[M.ARM] or "" for r in old) == ["", "", "corrections"]
        i["current_ledger"] = spark.createDataFrame(old, M.STORED)
    # the correction is withdrawn: what it put there goes, the booked rows stay
    i["corrections"] = spark.createDataFrame([(*row[:9], "other", *row[10:])], M.MERGED)
    old = M.merge_ledger(spark, i, MONTH_CLOSE, truck, bus).where(F.col("month") == "2001-01").collect()
    assert sorted(r["scene2"] for r in old) == ["fix", "fix", "other"]


def test_q8_pivot_option_one_row_per_bill_and_costs_agree(spark, sf):
    i = fixture_inputs(spark, sf)
    fan = C.bill_cost_detail(i["bill"], i["bill_lines"], i["settlement"], i["product"])
    one = C.bill_cost_detail(i["bill"], i["bill_lines"], i["settlement"], i["product"], pivot=True)
    assert one.groupBy("statement_id", "flow").count().where("count > 1").count() == 0
    assert one.count() == fan.select("statement_id", "flow").distinct().count()
    # channel cost and flag-'1' partner cost agree; flag-'0' cost is counted once instead of per channel row
    f = fan.groupBy("statement_id", "flow").agg(F.sum("cost_channel").alias("ch"), F.count("*").alias("n"),
                                                F.sum("cost_partner").alias("pc"))
    j = one.join(f, ["statement_id", "flow"])
    assert j.where(F.col("cost_channel") != F.col("ch")).count() == 0
    assert j.where((F.col("n") == 1) & (F.col("cost_partner") != F.col("pc"))).count() == 0
    assert j.where((F.col("n") == 2) & (F.col("cost_partner") > F.col("pc"))).count() == 0
