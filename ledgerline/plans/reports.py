"""Ledger reports: settlement slice (D5), waiver summary (D6), enriched
ledger (D7), ledger summary (D8) and the historic backfill (D3)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.functions.decision import Rule, decide
from ledgerline.functions.department import department
from ledgerline.functions.geo import province
from ledgerline.functions.rules import direction, keep, not_like, ordered_rule, recode
from ledgerline.operators.joins import attach_dimensions, attach_one_per_key, flag_existence, resolve_id
from ledgerline.schema import LEDGER, conform
from ledgerline.sources.snapshot import at_snapshot, month_in

# fixed values: scene2 labels the reports select on
ALL_DEVICES = "all_devices"
WAIVER_ROWS = "waiver"
SIGNING_ACTIVE = "signing_active"
SETTLEMENT_BANK = "bank_a"


def settlement_slice(ledger: DataFrame) -> DataFrame:
    """Truck rows except the named bank's signings and waivers."""
    c = F.col
    rule = keep([
        ((c("scene2") == F.lit(SIGNING_ACTIVE)) & (c("buyer") == F.lit(SETTLEMENT_BANK)), False),
        (c("scene2") == F.lit(WAIVER_ROWS), False),
    ])
    return ledger.where((c("segment") == F.lit(L.TRUCK)) & rule).select("*")


def waiver_devices(ledger: DataFrame) -> DataFrame:
    """The devices that D6 counts: one row per date, province, buyer and device."""
    rows = ledger.where((F.col("segment") == F.lit(L.TRUCK)) & (F.col("scene2") == F.lit(ALL_DEVICES)))
    return rows.select("date", province(F.col("obu_id")).alias("province"), "buyer", "obu_id").distinct()


def waiver_counts(devices: DataFrame, waived: DataFrame) -> DataFrame:
    """Devices per (date, province, buyer), split by whether ``waived(obu_id, buyer)``."""
    marked = flag_existence(devices, waived, ["obu_id", "buyer"], ["obu_id", "buyer"], "mark")
    return marked.groupBy("date", "province", "buyer", "mark").agg(F.count("obu_id").alias("amt"))


def waiver_summary(ledger: DataFrame) -> DataFrame:
    """Devices per (date, province, buyer), split by whether waived."""
    waived = ledger.where((F.col("segment") == F.lit(L.TRUCK)) & (F.col("scene2") == F.lit(WAIVER_ROWS)))
    return waiver_counts(waiver_devices(ledger), waived.select("obu_id", "buyer"))


def channel_members(external: DataFrame, shop_orders: DataFrame, shop_serials: DataFrame,
                    shop_items: DataFrame) -> DataFrame:
    """Devices sold through the live-stream channel (distinct)."""
    a = external.select(F.col("lasted_obu").alias("device"))
    chain = shop_orders.join(shop_serials, "o_id").join(shop_items, "uuid").select(F.col("sn").alias("device"))
    # one distinct over both sources (partial aggregation removes repeats
    # before the shuffle)
    return a.unionByName(chain).distinct()


def enrich(ledger: DataFrame, members: DataFrame, device: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Add department (P17) and province (P16) to every ledger row.  ``rules`` is a
    decision table over segment, scene, in_channel and open_name, the coded order if None."""
    c = F.col
    x = attach_dimensions(ledger, "obu_id", [
        (members, "device", {"__in_channel": None}),
        (device, "obuid", {"openname": F.max("openname")}),
    ])
    if rules is None:
        attributed = department(c("segment"), c("scene"), c("__in_channel"), c("openname"))
    else:
        attributed = decide(rules, {"segment": c("segment"), "scene": c("scene"), "in_channel": c("__in_channel"), "open_name": c("openname")})
    return x.select(*ledger.columns,
                    attributed.alias("department"),
                    province(c("obu_id")).alias("province"))


def ledger_summary(enriched: DataFrame) -> DataFrame:
    """Devices and money per 11 keys (price as double is a key)."""
    keys = [F.col("date"), "scene", "buyer", "preinstall", "data_type", "adjust_type", "segment", "scene2",
            "department", "province", F.col("price").cast("double").alias("price")]
    return enriched.groupBy(*keys).agg(F.count("obu_id").alias("obu_amt"), F.sum("price").alias("money"))


def latest_name(ledger: DataFrame, device: DataFrame, smart_text: str = "smart_etc") -> DataFrame:
    """J8 + A8 + F8: latest open name per device and whether it is a smart one."""
    x = attach_one_per_key(ledger.select("date", "obu_id", "price"), device, "obu_id", "obuid",
                           {"openname": F.max("openname")})
    return x.select("date", "obu_id", "price", "openname",
                    F.when(F.col("openname").like(f"{smart_text}%"), L.YES).otherwise(L.NO).alias("smart"))


# --------------------------------------------------------------------------- D3 backfill
# fixed values: backfill windows, pinned snapshot days, labels and rules
BACKFILL_DS = "20010701"          # pinned snapshot of the backed-up feeds
DETAIL_DS = "20010801"            # pinned snapshot of the id map
LEDGER_FROM, LEDGER_TO = "2001-07", "2001-09"   # months re-keyed in the current ledger
BACKFILL_FROM, BACKFILL_TO = "2001-03", "2001-06"
CANCEL_INCOME = "cancellation_income"
PREPAID_CORRECTION_UNTIL = "2001-04-30"
OLD_PREPAID_PRICE, NEW_PREPAID_PRICE = 87, 82
PREINSTALLED_TEXT = "%LOW%"       # rows whose channel text contains it are pre-installed
FIRST_USE_BANKS = ["bank_a", "bank_c"]
FIRST_USE_PRICE = 80
AUDIT_EXCLUDED_DEVICE = "4400000017"
AUDIT_BUYER = {"person": "personal_payer", "bank_a": "bank_a_corp"}


def backfill_arms(ledger: DataFrame, snapshot: DataFrame, audit: DataFrame) -> DataFrame:
    """D3 inputs: the current ledger's bus rows of the re-keyed months, plus
    the backed-up feeds of the historic months (a pinned snapshot)."""
    c = F.col
    s = at_snapshot(snapshot, BACKFILL_DS)
    s = s.where(month_in(s, "event_ts", BACKFILL_FROM, BACKFILL_TO))
    dev = F.concat(F.lit("D"), c("id"))  # device-keyed arms
    bus = dict(data_type=L.RECEIVABLE, adjust_type=L.RECEIVABLE, segment=L.BUS)
    day = c("event_ts")

    def arm(df, values, distinct=False):
        out = conform(df, values, LEDGER)
        return out.distinct() if distinct else out

    current = ledger.where((c("segment") == F.lit(L.BUS)) & (c("month") >= F.lit(LEDGER_FROM))
                           & (c("month") <= F.lit(LEDGER_TO)))
    backed_up = [
        arm(s, {"date": day, "scene": L.BUY_OUT, "buyer": "receiver", "price": 0, "obu_id": dev, **bus,
                "scene2": L.BUY_OUT}),
        arm(s, {"date": day, "scene": L.PREPAID, "buyer": "prepaid_payer",
                "price": ordered_rule([((F.to_date(day) <= F.lit(PREPAID_CORRECTION_UNTIL).cast("date"))
                                        & (c("price") == F.lit(OLD_PREPAID_PRICE)), NEW_PREPAID_PRICE)], c("price")),
                "obu_id": dev, **bus, "scene2": L.PREPAID}, distinct=True),
        arm(s.where((c("price") != 0) & not_like(c("dept"), PREINSTALLED_TEXT)),
            {"date": day, "scene": L.SIGNING, "buyer": c("bank"), "price": c("price"), "obu_id": dev, **bus,
             "scene2": "signing_active"}, distinct=True),
        arm(s, {"date": day, "scene": L.NEW_PAID, "buyer": "person", "price": c("price"), "obu_id": dev, **bus,
                "scene2": "new_paid_income"}),
        arm(s, {"date": day, "scene": L.AFTER_SALES_PAID, "buyer": "person", "price": c("price"), "obu_id": dev, **bus,
                "scene2": "after_sales_income"}),
        arm(s, {"date": day, "scene": L.CANCEL_PAID, "buyer": "person", "price": c("price"), "obu_id": c("id"), **bus,
                "scene2": CANCEL_INCOME}),
        arm(s.where(c("bank").isin(FIRST_USE_BANKS) & not_like(c("remark"), "%offline%") & (c("price") != 0)),
            {"date": day, "scene": L.SIGNING, "buyer": "bank_a_first_use", "price": FIRST_USE_PRICE,
             "obu_id": c("vehicle_id").cast("string"), **bus, "scene2": "first_use"}),
        audit_adjustments(audit.where(month_in(audit, "date", BACKFILL_FROM, BACKFILL_TO))),
    ]
    historic = reduce(lambda a, b: a.unionByName(b), backed_up)
    return conform(current, {n: f"@{n}" for n in LEDGER.fieldNames()}, LEDGER).unionByName(historic)


def audit_adjustments(audit: DataFrame) -> DataFrame:
    """P13 + P14 + F10: an audit adjustment file with ordered keep/drop rules,
    a buyer recode, a direction from the sign and a label per case."""
    c = F.col
    rule = keep([
        ((c("data_type") == F.lit(L.ADJUSTMENT)) & (c("adjust_type") == F.lit(L.DECREASE)), True),
        (c("obu_id") == F.lit(AUDIT_EXCLUDED_DEVICE), False),
        ((c("buyer") == F.lit("bank_b")) & (c("price") > 0), False),
    ])
    x = audit.where(rule & (c("segment") == F.lit(L.BUS)) & (c("scene") != F.lit(L.PREPAID)))
    return conform(x, {
        "date": c("date"), "scene": c("scene"), "buyer": recode(c("buyer"), AUDIT_BUYER, c("buyer")),
        "price": c("price"), "obu_id": c("obu_id"), "data_type": L.ADJUSTMENT,
        "adjust_type": direction(c("price"), L.INCREASE, L.DECREASE), "segment": L.BUS,
        "scene2": ordered_rule([(c("buyer") == F.lit("bank_a"), "signing_decrease"),
                                (c("scene") == F.lit(L.NEW_PAID), "new_paid_person_decrease"),
                                (c("scene") == F.lit(L.SIGNING), "signing_person_decrease")], has_default=False),
    }, LEDGER)


def id_map(detail: DataFrame, order_map: DataFrame) -> DataFrame:
    """J4 (nested): detail id -> its device, or the device of its service order when
    the detail row has none.  Not deduplicated (as modelled)."""
    d = at_snapshot(detail, DETAIL_DS).select("id", "obu_id", "service_order_id")
    m = d.join(order_map, d["service_order_id"] == order_map["order_id"], "left")
    return m.select(F.col("id"), F.coalesce(d["obu_id"], F.col("device_id")).alias("device"))


def backfill(ledger: DataFrame, snapshot: DataFrame, audit: DataFrame, detail: DataFrame, order_map: DataFrame,
             unique: bool = False) -> DataFrame:
    """D3: re-keyed current months plus historic months (each its own window,
    F3); cancellation-income rows keyed by a detail id are re-keyed to the
    device (J5 + P12).  A key with several mappings fans out unless unique."""
    c = F.col
    rows = backfill_arms(ledger, snapshot, audit)
    return resolve_id(rows, id_map(detail, order_map), "obu_id", "id", "device",
                      when=c("scene2") == F.lit(CANCEL_INCOME), unique=unique)
