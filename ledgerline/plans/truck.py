"""Truck ledger, 16 feeds (receivable, adjustments, card swap, all devices)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.context import RunContext
from ledgerline.functions.rules import ordered_rule
from ledgerline.operators.feeds import FeedSpec, feed_ledger, own_sources
from ledgerline.sources.snapshot import month_of

# fixed values: price rules of the truck feeds
PRICE_CHANGE_MONTH = "2001-07"  # from this event month a signing is priced 70
NAMED_BANK = "bank_a"
CHANGED_PRICE = 70
PARTNER_PRICE = 180
DECREASE_PRICE = -70
SIGN_CUT = "2001-05-20 00:00:00"  # signings before it always carry the key
WAIVER_DEPARTMENT = "2-HIGH"
CARD_SWAP_CATEGORY = "card_swap"
OWN_DEPARTMENT = "data"


# fixed values: the event column of each feed's table
TRUCK_EVENTS = {
    "T1_signing": "signed_time", "T2_first_use": "first_use_time", "T3_partner": "issued_time", "T4_new_paid": "paid_time",
    "T5_after_sales": "after_sales_time", "T6_cancellation": "cancel_time", "T7_waiver": "waived_time",
    "T9_signing_increase": "increase_time", "T10_new_paid_increase": "paid_increase_time", "T11_signing_decrease": "rescind_time",
    "T12_new_paid_decrease": "paid_decrease_time", "T13_after_sales_decrease": "after_sales_refund_time",
    "T14_cancellation_decrease": "due_refund_time", "T16_all_devices": "device_time",
}


def truck_specs() -> list[FeedSpec]:
    c = F.col
    ev_month = month_of("event_ts")
    snap = dict(source="snapshot", event="event_ts", segment=L.TRUCK, preinstall=c("preinstall"))
    adj = dict(data_type=L.ADJUSTMENT)
    swap = c("category") == F.lit(CARD_SWAP_CATEGORY)
    own = (c("department") == F.lit(OWN_DEPARTMENT))
    # The key exists only when the sign-time / mark rule holds; the slice and the
    # floor are on the event, which for this feed is the rescission
    decrease_key = ordered_rule(
        [
            (c("sign_time") < F.lit(SIGN_CUT).cast("timestamp_ntz"), c("vehicle_id")),
            ((c("sign_time") >= F.lit(SIGN_CUT).cast("timestamp_ntz")) & (c("remark") == F.lit("increase")), c("vehicle_id")),
        ],
        has_default=False,
    ).cast("string")
    return own_sources([
        FeedSpec("T1_signing", **snap, scene2="signing_active", scene=L.SIGNING, buyer=c("bank"),
                 price=ordered_rule([((ev_month >= F.lit(PRICE_CHANGE_MONTH)) & (c("bank") == F.lit(NAMED_BANK)), CHANGED_PRICE)], c("price")),
                 key=c("id")),
        FeedSpec("T2_first_use", **snap, scene2="first_use", scene=L.SIGNING, buyer="bank_a_first_use",
                 price=ordered_rule([(ev_month >= F.lit(PRICE_CHANGE_MONTH), CHANGED_PRICE)], c("price")), key=c("id")),
        FeedSpec("T3_partner", **snap, scene2="partner_product", scene=L.SIGNING, buyer="partner",
                 price=PARTNER_PRICE, key=c("id"), where=c("dept") == F.lit("1-URGENT")),
        FeedSpec("T4_new_paid", **snap, scene2=L.NEW_PAID, scene=L.NEW_PAID, buyer="person",
                 price=ordered_rule([(c("remark") == F.lit("decrease"), -180), (c("remark") == F.lit("increase"), 180)], c("price")),
                 key=c("id")),
        FeedSpec("T5_after_sales", **snap, scene2=L.AFTER_SALES, scene=L.AFTER_SALES, buyer="person",
                 price=ordered_rule([(c("price") == F.lit(-180), -180)], 180), key=c("id")),
        FeedSpec("T6_cancellation", **snap, scene2=L.CANCELLATION, scene=L.CANCELLATION, buyer="person",
                 price=c("price"), key=c("id"), distinct=False),
        FeedSpec("T7_waiver", **snap, scene2=L.WAIVER, scene=L.WAIVER, buyer=c("bank"), price=0, key=c("id"),
                 distinct=False, floor=False, where=c("dept") == F.lit(WAIVER_DEPARTMENT)),
        FeedSpec("T8_card_swap", source="equipment", event="gmt_payment", segment=L.TRUCK, slice="table", preinstall=c("preinstall"),
                 scene2="card_swap_received", scene=L.CARD_SWAP, buyer=L.CARD_SWAP, price=c("equipment_amount"),
                 key=F.coalesce(c("provider_id"), c("id")), distinct=False,
                 where=(c("pay_state") == F.lit("SUCCESS")) & swap & own & (c("sale_department") == F.lit(OWN_DEPARTMENT))),
        FeedSpec("T9_signing_increase", **snap, **adj, adjust_type=L.INCREASE, scene2="signing_increase", scene=L.SIGNING,
                 buyer=c("bank"), price=c("price"), key=c("id"), where=c("remark") == F.lit("increase")),
        FeedSpec("T10_new_paid_increase", **snap, **adj, adjust_type=L.INCREASE, scene2="new_paid_increase", scene=L.NEW_PAID,
                 buyer="person", price=c("price"), key=c("id"), where=(c("remark") == F.lit("increase")) & (c("price") > 0)),
        FeedSpec("T11_signing_decrease", **snap, **adj, adjust_type=L.DECREASE, scene2="signing_decrease", scene=L.SIGNING,
                 buyer="bank_a_first_use", price=DECREASE_PRICE, key=decrease_key, where=decrease_key.isNotNull()),
        FeedSpec("T12_new_paid_decrease", **snap, **adj, adjust_type=L.DECREASE, scene2="new_paid_decrease", scene=L.NEW_PAID,
                 buyer="person", price=-c("price"), key=c("id"), where=c("remark") == F.lit("decrease")),
        FeedSpec("T13_after_sales_decrease", **snap, **adj, adjust_type=L.DECREASE, scene2="after_sales_decrease",
                 scene=L.AFTER_SALES, buyer="person", price=-c("price"), key=c("id"), where=c("remark") == F.lit("offline")),
        FeedSpec("T14_cancellation_decrease", **snap, **adj, adjust_type=L.DECREASE, scene2="cancellation_decrease",
                 scene=L.CANCELLATION, buyer="person", price=-c("price"),
                 key=F.coalesce(c("new_obu_id"), c("provider_id")),
                 distinct=False, where=c("remark").isNull()),
        FeedSpec("T15_card_swap_refund", **adj, adjust_type=L.DECREASE, source="equipment", event="gmt_refund", segment=L.TRUCK, slice="table", preinstall=c("preinstall"),
                 scene2="card_swap_refund", scene=L.CARD_SWAP, buyer=L.CARD_SWAP, price=-c("equipment_amount"),
                 key=F.coalesce(c("provider_id"), c("id")), distinct=False,
                 where=(c("refund_state") == F.lit("REFUND_SUCCESS")) & swap & own & (c("sale_department") == F.lit(OWN_DEPARTMENT))),
        FeedSpec("T16_all_devices", **{**snap, "segment": L.TRUCK}, slice="today", scene2="all_devices", scene="all_devices",
                 buyer=c("bank"), price=0, key=c("id"), distinct=False, where=c("dept") != F.lit("5-LOW")),
    ], TRUCK_EVENTS)


def truck_ledger(inputs, ctx: RunContext, mode: str = "incremental", months: list[str] | None = None) -> DataFrame:
    return feed_ledger(truck_specs(), inputs, ctx, mode, months)
