"""Truck and bus ledgers (all feeds), their rebuild union and feed-level rule checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline import labels as L
from ledgerline.context import RunContext
from ledgerline.functions.rules import keep, ordered_rule
from ledgerline.operators.feeds import build_feed, union_feeds
from ledgerline.oracle import both_arms, snapshot_arms, two_arm, window_filter
from ledgerline.plans.bus import bus_ledger
from ledgerline.plans.inputs import fixture_inputs
from ledgerline.plans.truck import truck_ledger, truck_specs
from ledgerline.registry.base import MID_MONTH, MONTH_CLOSE, register
from ledgerline.schema import for_compare
from ledgerline.sources import fixtures as fx
from ledgerline.sources.snapshot import month_of, snapshot_union


def _ledger_sel(date_expr, scene, buyer, price, key, data_type, adjust_type, segment, scene2, preinstall="NULL"):
    return (f"CAST({date_expr} AS DATE) AS date, {scene} AS scene, {buyer} AS buyer, "
            f"CAST({price} AS DECIMAL(18,2)) AS price, CAST({preinstall} AS VARCHAR) AS preinstall, "
            f"CAST({key} AS VARCHAR) AS obu_id, '{data_type}' AS data_type, '{adjust_type}' AS adjust_type, "
            f"'{segment}' AS segment, {scene2} AS scene2, strftime(CAST({date_expr} AS DATE), '%Y-%m') AS month")


_KEY11 = ("CASE WHEN sign_time < TIMESTAMP '2001-05-20 00:00:00' THEN vehicle_id "
          "WHEN sign_time >= TIMESTAMP '2001-05-20 00:00:00' AND remark = 'increase' THEN vehicle_id END")


def _carried(*args):
    """Truck feeds carry the pre-installation mark."""
    return _ledger_sel(*args, preinstall="preinstall")


def _truck_body(ctx: RunContext) -> str:
    fl = ctx.floor_month
    R, A, T = L.RECEIVABLE, L.ADJUSTMENT, L.TRUCK
    ev = "event_ts"
    arms = [
        two_arm(_carried(ev, "'signing'", "bank", "CASE WHEN strftime(event_ts, '%Y-%m') >= '2001-07' AND bank = 'bank_a' THEN 70 ELSE price END",
                            "id", R, R, T, "'signing_active'"), floor=fl),
        two_arm(_carried(ev, "'signing'", "'bank_a_first_use'", "CASE WHEN strftime(event_ts, '%Y-%m') >= '2001-07' THEN 70 ELSE price END",
                            "id", R, R, T, "'first_use'"), floor=fl),
        two_arm(_carried(ev, "'signing'", "'partner'", "180", "id", R, R, T, "'partner_product'"), where="dept = '1-URGENT'", floor=fl),
        two_arm(_carried(ev, "'new_paid'", "'person'", "CASE WHEN remark = 'decrease' THEN -180 WHEN remark = 'increase' THEN 180 ELSE price END",
                            "id", R, R, T, "'new_paid'"), floor=fl),
        two_arm(_carried(ev, "'after_sales'", "'person'", "CASE WHEN price = -180 THEN -180 ELSE 180 END", "id", R, R, T, "'after_sales'"), floor=fl, slices="after"),
        two_arm(_carried(ev, "'cancellation'", "'person'", "price", "id", R, R, T, "'cancellation'"), distinct=False, floor=fl),
        two_arm(_carried(ev, "'waiver'", "bank", "0", "id", R, R, T, "'waiver'"), where="dept = '2-HIGH'", distinct=False),
        "SELECT " + _carried("gmt_payment", "'card_swap'", "'card_swap'", "equipment_amount", "coalesce(provider_id, id)", R, R, T,
                                "'card_swap_received'")
        + " FROM fx_equipment WHERE pay_state = 'SUCCESS' AND category = 'card_swap' AND department = 'data' "
          f"AND sale_department = 'data' AND strftime(gmt_payment, '%Y-%m') >= '{fl}'",
        two_arm(_carried(ev, "'signing'", "bank", "price", "id", A, L.INCREASE, T, "'signing_increase'"), where="remark = 'increase'", floor=fl),
        two_arm(_carried(ev, "'new_paid'", "'person'", "price", "id", A, L.INCREASE, T, "'new_paid_increase'"),
                where="remark = 'increase' AND price > 0", floor=fl),
        two_arm(_carried(ev, "'signing'", "'bank_a_first_use'", "-70", _KEY11, A, L.DECREASE, T, "'signing_decrease'"),
                where=f"({_KEY11}) IS NOT NULL", floor=fl),
        two_arm(_carried(ev, "'new_paid'", "'person'", "0 - price", "id", A, L.DECREASE, T, "'new_paid_decrease'"),
                where="remark = 'decrease'", floor=fl),
        two_arm(_carried(ev, "'after_sales'", "'person'", "0 - price", "id", A, L.DECREASE, T, "'after_sales_decrease'"),
                where="remark = 'offline'", floor=fl, slices="after"),
        two_arm(_carried(ev, "'cancellation'", "'person'", "0 - price", "coalesce(new_obu_id, provider_id)", A, L.DECREASE, T, "'cancellation_decrease'"),
                where="remark IS NULL", distinct=False, floor=fl),
        "SELECT " + _carried("gmt_refund", "'card_swap'", "'card_swap'", "0 - equipment_amount", "coalesce(provider_id, id)", A, L.DECREASE, T,
                                "'card_swap_refund'")
        + " FROM fx_equipment WHERE refund_state = 'REFUND_SUCCESS' AND category = 'card_swap' AND department = 'data' "
          f"AND sale_department = 'data' AND strftime(gmt_refund, '%Y-%m') >= '{fl}'",
        "SELECT " + _carried(ev, "'all_devices'", "bank", "0", "id", R, R, T, "'all_devices'")
        + f" FROM fx_snapshot WHERE ds = '{ctx.ds}' AND strftime(event_ts, '%Y-%m') >= '{fl}' AND dept <> '5-LOW'",
    ]
    return "\nUNION ALL\n".join(f"SELECT * FROM ({a}) a{i}" for i, a in enumerate(arms))


def _bus_body(ctx: RunContext) -> str:
    fl = ctx.floor_month
    R, A, B = L.RECEIVABLE, L.ADJUSTMENT, L.BUS
    ev = "event_ts"
    dec = "remark = 'decrease'"
    adj_scene = "CASE {0} WHEN 'new_paid' THEN 'new_paid' WHEN 'prepaid' THEN 'cancel_paid' WHEN 'signing' THEN 'after_sales_paid' END"
    adj_label = ("CASE {0} WHEN 'new_paid' THEN 'new_paid_person_decrease' WHEN 'prepaid' THEN 'cancel_person_decrease' "
                 "WHEN 'signing' THEN 'after_sales_person_decrease' END")
    arms = [
        two_arm(_ledger_sel(ev, "'signing'", "bank", "price", "id", R, R, B, "'bus_signing'", preinstall="''"), floor=fl),
        two_arm(_ledger_sel(ev, "'signing'", "'first_use'",
                            "CASE WHEN remark = 'offline' THEN price WHEN strftime(event_ts, '%Y-%m') >= '2001-07' THEN 70 ELSE 80 END",
                            "id", R, R, B, "'bus_first_use'"), floor=fl),
        two_arm(_ledger_sel(ev, "'new_paid'", "'person'", "price", "id", R, R, B, "'bus_new_paid'"), floor=fl),
        two_arm(_ledger_sel(ev, "'after_sales_paid'", "'person'", "price", "id", R, R, B, "'bus_after_sales'"), floor=fl, slices="after"),
        two_arm(_ledger_sel(ev, "'cancel_paid'", "'person'", "price", "id", R, R, B, "'bus_cancellation'"), floor=fl),
        two_arm(_ledger_sel(ev, "'buy_out'", "bank || '|' || agent", "price", "id", R, R, B, "'bus_buy_out'"), floor=fl),
        two_arm(_ledger_sel(ev, "'prepaid'", "'prepaid_payer'", "price", "id", R, R, B, "'bus_prepaid'"),
                where="CASE WHEN CAST(event_ts AS DATE) < DATE '2001-06-01' THEN 1 WHEN agent LIKE '%test%' THEN 0 ELSE 1 END = 1",
                floor=fl),
        two_arm(_ledger_sel(ev, "'signing'", "bank", "0 - price", "id", A, L.DECREASE, B, "'bus_signing_decrease'"), where=dec, floor=fl),
        two_arm(_ledger_sel(ev, "'new_paid'", "'person'", "0 - price", "id", A, L.DECREASE, B, "'bus_new_paid_decrease'"), where=dec, floor=fl),
        two_arm(_ledger_sel(ev, "'after_sales_paid'", "'person'", "0 - price", "id", A, L.DECREASE, B, "'bus_after_sales_decrease'"),
                where=dec, floor=fl, slices="after"),
        two_arm(_ledger_sel(ev, "'cancel_paid'", "'person'", "0 - price", "id", A, L.DECREASE, B, "'bus_cancel_decrease'"), where=dec, floor=fl),
        "SELECT " + _ledger_sel("date", adj_scene.format("scene"), "'person'", "money", "obu_id", A, L.DECREASE, B, adj_label.format("scene"))
        + " FROM fx_live_adjustments",
        "SELECT " + _ledger_sel("date", adj_scene.format("scene2"), "'person'", "price", "obu_id", A, L.DECREASE, B, adj_label.format("scene2"))
        + " FROM fx_manual_income",
    ]
    return "\nUNION ALL\n".join(f"SELECT * FROM ({a}) b{i}" for i, a in enumerate(arms))


_LEDGER_COLS = ("SELECT date, scene, buyer, CAST(price AS DOUBLE) AS price, preinstall, obu_id, data_type, "
                "adjust_type, segment, scene2, month")
TRUCK_SQL = fx.with_fixtures(f"{_LEDGER_COLS} FROM ({_truck_body(MONTH_CLOSE)}) u WHERE {window_filter(MONTH_CLOSE)}",
                             ["fx_snapshot", "fx_after_sales", "fx_equipment"], both_arms(MONTH_CLOSE))
BUS_SQL = fx.with_fixtures(f"{_LEDGER_COLS} FROM ({_bus_body(MONTH_CLOSE)}) u WHERE {window_filter(MONTH_CLOSE)}",
                           ["fx_snapshot", "fx_after_sales", "fx_live_adjustments", "fx_manual_income"], both_arms(MONTH_CLOSE))
UNION_SQL = fx.with_fixtures(
    f"{_LEDGER_COLS} FROM ({_truck_body(MONTH_CLOSE)}\nUNION ALL\n{_bus_body(MONTH_CLOSE)}) u",
    ["fx_snapshot", "fx_after_sales", "fx_equipment", "fx_live_adjustments", "fx_manual_income"], both_arms(MONTH_CLOSE))


@register("ledger_truck", TRUCK_SQL)
def ledger_truck(spark: SparkSession, root: str) -> DataFrame:
    """All 16 truck feeds, conformed, unioned by name, rewrite window."""
    return for_compare(truck_ledger(fixture_inputs(spark, root), MONTH_CLOSE))


@register("ledger_bus", BUS_SQL)
def ledger_bus(spark: SparkSession, root: str) -> DataFrame:
    """All 13 bus feeds (11 snapshot feeds, 2 manual adjustment feeds)."""
    return for_compare(bus_ledger(fixture_inputs(spark, root), MONTH_CLOSE))


@register("ledger_union", UNION_SQL)
def ledger_union(spark: SparkSession, root: str) -> DataFrame:
    """Both ledgers in rebuild mode (every closed month),
    29 conformed feeds stacked by name."""
    inputs = fixture_inputs(spark, root)
    return for_compare(truck_ledger(inputs, MONTH_CLOSE, mode="rebuild")
                       .unionByName(bus_ledger(inputs, MONTH_CLOSE, mode="rebuild")))


# fixed values: historic price correction (P8): 87 became 82 before this day
HISTORIC_PRICE, CORRECTED_PRICE, HISTORIC_UNTIL = 87, 82, "2001-07-10"


@register("feed_price_rules", fx.with_fixtures(
    "SELECT * FROM (" + two_arm(
        "id AS obu_id, CAST(event_ts AS DATE) AS date, "
        "CASE WHEN strftime(event_ts, '%Y-%m') >= '2001-07' AND bank = 'bank_a' THEN 70 ELSE price END AS p_signing, "
        "CASE WHEN remark = 'offline' THEN price WHEN strftime(event_ts, '%Y-%m') >= '2001-07' THEN 70 ELSE 80 END AS p_first_use, "
        "CASE WHEN remark = 'decrease' THEN -180 WHEN remark = 'increase' THEN 180 ELSE price END AS p_new_paid, "
        "CASE WHEN price = -180 THEN -180 ELSE 180 END AS p_after_sales, "
        "CASE WHEN price = 87 AND CAST(event_ts AS DATE) < DATE '2001-07-10' THEN 82 ELSE price END AS p_history",
        floor="2001-05") + f") t WHERE {window_filter(MID_MONTH)}", ["fx_snapshot"], snapshot_arms(MID_MONTH)))
def feed_price_rules(spark: SparkSession, root: str) -> DataFrame:
    """Price overrides by effective month and bank, by source then
    month, by remark (three-way and binary), historic correction."""
    c = F.col
    x = snapshot_union(fx.fx_snapshot(spark, root), "event_ts", MID_MONTH)
    ev = month_of("event_ts")
    return x.select(
        c("id").alias("obu_id"), F.to_date("event_ts").alias("date"),
        ordered_rule([((ev >= F.lit("2001-07")) & (c("bank") == F.lit("bank_a")), 70)], c("price")).alias("p_signing"),
        ordered_rule([(c("remark") == F.lit("offline"), c("price")), (ev >= F.lit("2001-07"), 70)], 80).alias("p_first_use"),
        ordered_rule([(c("remark") == F.lit("decrease"), -180), (c("remark") == F.lit("increase"), 180)], c("price")).alias("p_new_paid"),
        ordered_rule([(c("price") == F.lit(-180), -180)], 180).alias("p_after_sales"),
        ordered_rule([((c("price") == F.lit(HISTORIC_PRICE)) & (F.to_date("event_ts") < F.lit(HISTORIC_UNTIL).cast("date")),
                       CORRECTED_PRICE)], c("price")).alias("p_history"),
    ).distinct()


def _spec(name):
    return next(s for s in truck_specs() if s.name == name)


_DECREASE_ARMS = [
    two_arm(_carried("event_ts", "'signing'", "'bank_a_first_use'", "-70", _KEY11, L.ADJUSTMENT, L.DECREASE, L.TRUCK,
                        "'signing_decrease'"), where=f"({_KEY11}) IS NOT NULL", floor="2001-05"),
    two_arm(_carried("event_ts", "'new_paid'", "'person'", "0 - price", "id", L.ADJUSTMENT, L.DECREASE, L.TRUCK,
                        "'new_paid_decrease'"), where="remark = 'decrease'", floor="2001-05"),
    two_arm(_carried("event_ts", "'cancellation'", "'person'", "0 - price", "coalesce(new_obu_id, provider_id)", L.ADJUSTMENT,
                        L.DECREASE, L.TRUCK, "'cancellation_decrease'"), where="remark IS NULL", distinct=False,
            floor="2001-05"),
]
_LEDGER_OUT = ("SELECT date, scene, buyer, CAST(price AS DOUBLE) AS price, preinstall, obu_id, data_type, adjust_type, "
               "segment, scene2, month")


@register("feed_decrease_key", fx.with_fixtures(
    f"{_LEDGER_OUT} FROM (" + "\nUNION ALL\n".join(f"SELECT * FROM ({a}) a{i}" for i, a in enumerate(_DECREASE_ARMS))
    + ") u", ["fx_snapshot"], snapshot_arms(MONTH_CLOSE)))
def feed_decrease_key(spark: SparkSession, root: str) -> DataFrame:
    """P9-P11, F11 (rebuild mode): negated prices, fallback key, conditional
    key that must exist."""
    snap = fx.fx_snapshot(spark, root)
    frames = [build_feed(_spec(n), snap, MONTH_CLOSE, mode="rebuild")
              for n in ("T11_signing_decrease", "T12_new_paid_decrease", "T14_cancellation_decrease")]
    return for_compare(union_feeds(frames))


_SWAP_ARMS = [
    "SELECT " + _carried("gmt_payment", "'card_swap'", "'card_swap'", "equipment_amount", "coalesce(provider_id, id)",
                            L.RECEIVABLE, L.RECEIVABLE, L.TRUCK, "'card_swap_received'")
    + " FROM fx_equipment WHERE pay_state = 'SUCCESS' AND category = 'card_swap' AND department = 'data' "
      "AND sale_department = 'data' AND strftime(gmt_payment, '%Y-%m') >= '2001-05'",
    "SELECT " + _carried("gmt_refund", "'card_swap'", "'card_swap'", "0 - equipment_amount", "coalesce(provider_id, id)",
                            L.ADJUSTMENT, L.DECREASE, L.TRUCK, "'card_swap_refund'")
    + " FROM fx_equipment WHERE refund_state = 'REFUND_SUCCESS' AND category = 'card_swap' AND department = 'data' "
      "AND sale_department = 'data' AND strftime(gmt_refund, '%Y-%m') >= '2001-05'",
]


@register("feed_card_swap", fx.with_fixtures(
    f"{_LEDGER_OUT} FROM ({_SWAP_ARMS[0]} UNION ALL {_SWAP_ARMS[1]}) u", ["fx_equipment"]))
def feed_card_swap(spark: SparkSession, root: str) -> DataFrame:
    """Card-swap payments and refunds from a plain table."""
    eq = fx.fx_equipment(spark, root)
    frames = [build_feed(_spec(n), eq, MONTH_CLOSE) for n in ("T8_card_swap", "T15_card_swap_refund")]
    return for_compare(union_feeds(frames))


@register("feed_composite_buyer", """
SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS date,
       c.c_mktsegment || '|' || CASE WHEN o.o_orderpriority <> '5-LOW' THEN o.o_orderpriority END AS buyer
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
WHERE CASE WHEN o.o_orderdate < TIMESTAMP '1996-01-01 00:00:00' THEN 1
           WHEN c.c_name LIKE '%1' THEN 0 ELSE 1 END = 1
""")
def feed_composite_buyer(spark: SparkSession, root: str) -> DataFrame:
    """P26 (concat is NULL when a part is NULL) and F10 (CASE as predicate:
    old rows always kept, then test names excluded, NULL falls to keep)."""
    c = F.col
    o = fx.load_table(spark, root, "orders")
    cu = fx.load_table(spark, root, "customer")
    x = o.join(cu, cu["c_custkey"] == o["o_custkey"])
    rule = keep([(c("o_orderdate") < F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"), True),
                 (c("c_name").like("%1"), False)])
    part = F.when(c("o_orderpriority") != F.lit("5-LOW"), c("o_orderpriority"))
    return x.where(rule).select(c("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("date"),
                                F.concat(c("c_mktsegment"), F.lit("|"), part).alias("buyer"))
