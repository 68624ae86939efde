"""Bus ledger, 13 feeds (11 snapshot feeds + 2 manual adjustment feeds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.context import RunContext
from ledgerline.functions.rules import keep, ordered_rule, recode
from ledgerline.operators.feeds import FeedSpec, feed_ledger, own_sources
from ledgerline.sources.snapshot import month_of

# fixed values: price rules of the bus feeds
PRICE_CHANGE_MONTH = "2001-07"
OFFLINE_SOURCE = "offline"
CHANGED_PRICE = 70
OLD_PRICE = 80
TEST_AGENT_PATTERN = "%test%"
TEST_AGENT_RULE_FROM = "2001-06-01"  # test agents are excluded from this day on
PREPAID_BUYER = "prepaid_payer"

# fixed values: manual adjustment recodes (P13): the adjustment file's scene
# -> ledger scene, and -> adjustment label (unlisted scenes give NULL)
ADJUST_SCENE = {"new_paid": L.NEW_PAID, "prepaid": L.CANCEL_PAID, "signing": L.AFTER_SALES_PAID}
ADJUST_LABEL = {"new_paid": "new_paid_person_decrease", "prepaid": "cancel_person_decrease",
                "signing": "after_sales_person_decrease"}
# fixed values: the event column of each feed's table
BUS_EVENTS = {
    "U1_signing": "signed_time", "U2_first_use": "first_use_time", "U3_new_paid": "paid_time", "U4_after_sales": "after_sales_time",
    "U5_cancellation": "cancel_time", "U6_buy_out": "operated_time", "U7_prepaid": "prepaid_time",
    "U8_signing_decrease": "sign_decrease_time", "U9_new_paid_decrease": "paid_decrease_time",
    "U10_after_sales_decrease": "after_sales_refund_time", "U11_cancel_decrease": "due_refund_time",
}


def bus_specs() -> list[FeedSpec]:
    c = F.col
    ev_month = month_of("event_ts")
    snap = dict(source="snapshot", event="event_ts", segment=L.BUS)
    dec = dict(data_type=L.ADJUSTMENT, adjust_type=L.DECREASE, where=c("remark") == F.lit("decrease"))
    agent_ok = keep([
        (F.to_date("event_ts") < F.lit(TEST_AGENT_RULE_FROM).cast("date"), True),
        (c("agent").like(TEST_AGENT_PATTERN), False),
    ])
    return own_sources([
        FeedSpec("U1_signing", **snap, scene2="bus_signing", scene=L.SIGNING, buyer=c("bank"), price=c("price"),
                 key=c("id"), preinstall="", dedup_raw_event=True),
        FeedSpec("U2_first_use", **snap, scene2="bus_first_use", scene=L.SIGNING, buyer="first_use",
                 price=ordered_rule([(c("remark") == F.lit(OFFLINE_SOURCE), c("price")),
                                     (ev_month >= F.lit(PRICE_CHANGE_MONTH), CHANGED_PRICE)], OLD_PRICE),
                 key=c("id")),
        FeedSpec("U3_new_paid", **snap, scene2="bus_new_paid", scene=L.NEW_PAID, buyer="person", price=c("price"), key=c("id")),
        FeedSpec("U4_after_sales", **snap, scene2="bus_after_sales", scene=L.AFTER_SALES_PAID, buyer="person",
                 price=c("price"), key=c("id")),
        FeedSpec("U5_cancellation", **snap, scene2="bus_cancellation", scene=L.CANCEL_PAID, buyer="person",
                 price=c("price"), key=c("id")),
        FeedSpec("U6_buy_out", **snap, scene2="bus_buy_out", scene=L.BUY_OUT,
                 buyer=F.concat(c("bank"), F.lit("|"), c("agent")), price=c("price"), key=c("id")),
        FeedSpec("U7_prepaid", **snap, scene2="bus_prepaid", scene=L.PREPAID, buyer=PREPAID_BUYER, price=c("price"),
                 key=c("id"), where=agent_ok),
        FeedSpec("U8_signing_decrease", **snap, **dec, scene2="bus_signing_decrease", scene=L.SIGNING, buyer=c("bank"),
                 price=-c("price"), key=c("id")),
        FeedSpec("U9_new_paid_decrease", **snap, **dec, scene2="bus_new_paid_decrease", scene=L.NEW_PAID, buyer="person",
                 price=-c("price"), key=c("id")),
        FeedSpec("U10_after_sales_decrease", **snap, **dec, scene2="bus_after_sales_decrease", scene=L.AFTER_SALES_PAID,
                 buyer="person", price=-c("price"), key=c("id")),
        FeedSpec("U11_cancel_decrease", **snap, **dec, scene2="bus_cancel_decrease", scene=L.CANCEL_PAID, buyer="person",
                 price=-c("price"), key=c("id")),
        FeedSpec("U12_manual_person", source="live_adjustments", event="date", segment=L.BUS, slice="table", floor=False,
                 scene2=recode(c("scene"), ADJUST_LABEL), scene=recode(c("scene"), ADJUST_SCENE), buyer="person",
                 price=c("money"), key=c("obu_id"), data_type=L.ADJUSTMENT, adjust_type=L.DECREASE, distinct=False),
        FeedSpec("U13_manual_income", source="manual_income", event="date", segment=L.BUS, slice="table", floor=False,
                 scene2=recode(c("scene2"), ADJUST_LABEL), scene=recode(c("scene2"), ADJUST_SCENE), buyer="person",
                 price=c("price"), key=c("obu_id"), data_type=L.ADJUSTMENT, adjust_type=L.DECREASE, distinct=False),
    ], BUS_EVENTS)


def bus_ledger(inputs, ctx: RunContext, mode: str = "incremental", months: list[str] | None = None) -> DataFrame:
    return feed_ledger(bus_specs(), inputs, ctx, mode, months)
