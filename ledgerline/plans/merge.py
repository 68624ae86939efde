"""Merge truck and bus ledgers with the adjustment arms, then tax split.

Arms: truck ledger (all rows), bus ledger (rows with a device), three
ledger-shaped correction tables, one constant correction row, three label-mapped
adjustment files, and corrections derived from the current ledger.  The
after-tax price is recomputed once over the union (arm values are ignored),
then the rewrite window keeps the months the run owns.  Every adjustment is stored
with the name of its arm, so that a later run knows its own corrections.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.context import RunContext
from ledgerline.functions.rules import direction, recode
from ledgerline.functions.tax import net_price
from ledgerline.operators.adjustments import adjustment, constant_rows, ledger_shaped, self_correction
from ledgerline.operators.feeds import rewrite_window, union_feeds
from ledgerline.operators.joins import staged
from ledgerline.schema import ARM, LEDGER, MERGED, STORED, conform
from ledgerline.sources.snapshot import month_from

# fixed values: the constant correction row
CONSTANT_CORRECTION = {
    "date": date(2001, 7, 6), "scene": L.SIGNING, "buyer": "bank_c", "price": Decimal("-180"),
    "preinstall": "not_preinstalled", "obu_id": "DEV-CORR-0001", "data_type": L.ADJUSTMENT,
    "adjust_type": L.DECREASE, "segment": L.TRUCK, "scene2": "signing_quarter_correction",
    "net_price": Decimal("0"), "month": "2001-07",
}
# fixed values: label-mapped adjustment file (S9): its month -> quarter label
QUARTER_LABEL = {"2001-04": "q2_bus_bank", "2001-05": "q2_bus_bank", "2001-06": "q2_bus_bank",
                 "2001-07": "q3_bus_bank", "2001-08": "q3_bus_bank", "2001-09": "q3_bus_bank"}
ADJUSTMENT_DAY = date(2001, 7, 31)
ADJUSTMENT_MONTH = "2001-07"
# fixed values: self-correction (S11): devices re-priced at -80, for rows
# before the correction month
SELF_CORRECTION_PRICE = Decimal("-80")
SELF_CORRECTION_BEFORE = "2001-07"


def self_correction_ids() -> list[str]:
    """20 device ids (prefix 44, part keys 17, 34, ..., 340)."""
    return ["44" + str(17 * k).zfill(8) for k in range(1, 21)]


# fixed values: corrections of personal payments (S9), by service or by scene
PERSON_SCENE = {"new_paid": L.NEW_PAID, "prepaid": L.CANCEL_PAID, "signing": L.AFTER_SALES_PAID}
PERSON_MONTH = "2001-06"


def merge_arms(spark: SparkSession, truck: DataFrame, bus: DataFrame, inputs) -> dict[str, DataFrame]:
    """The ten arms by name, each conformed."""
    c = F.col
    no_net = F.lit(None).cast("decimal(18,6)")
    decrease = {"buyer": "person", "price": c("price"), "obu_id": c("obu_id"), "data_type": L.ADJUSTMENT,
                "adjust_type": L.DECREASE, "segment": L.BUS, "net_price": 0}
    return {
        "truck": ledger_shaped(truck.withColumn("net_price", no_net), MERGED),
        "bus": ledger_shaped(bus.where(c("obu_id").isNotNull()).withColumn("net_price", no_net), MERGED),
        "corrections": ledger_shaped(inputs["corrections"], MERGED),
        "corrections_second": ledger_shaped(inputs["corrections_second"], MERGED),
        "constant": constant_rows(spark, [CONSTANT_CORRECTION], MERGED),
        # free date, fixed month
        "person_by_service": adjustment(inputs["person_services"], {
            **decrease, "date": c("date"), "scene": recode(c("scene2"), PERSON_SCENE), "scene2": "person_half_year_decrease",
            "month": PERSON_MONTH}, MERGED),
        "recoded_bank": adjustment(inputs["adjust_file"], {
            "date": F.lit(ADJUSTMENT_DAY), "scene": L.SIGNING, "buyer": "bank_b", "price": c("price"),
            "obu_id": c("obu_id"), "data_type": L.ADJUSTMENT,
            "adjust_type": direction(c("price"), L.INCREASE, L.DECREASE),
            "segment": L.BUS, "scene2": recode(c("month"), QUARTER_LABEL), "net_price": 0,
            "month": ADJUSTMENT_MONTH,
        }, MERGED),
        "person_by_scene": adjustment(inputs["person_scenes"], {
            **decrease, "date": F.lit(ADJUSTMENT_DAY), "scene": c("scene"), "scene2": "person_year_decrease",
            "month": ADJUSTMENT_MONTH}, MERGED),
        "self_correction": self_correction(
            inputs["current_ledger"], self_correction_ids(),
            (c("scene") == F.lit(L.SIGNING)) & (c("data_type") == F.lit(L.RECEIVABLE))
            & (c("month") < F.lit(SELF_CORRECTION_BEFORE)),
            {"date": F.lit(ADJUSTMENT_DAY), "scene": L.SIGNING, "buyer": "bank_a_first_use",
             "price": SELF_CORRECTION_PRICE, "preinstall": "not_preinstalled", "obu_id": c("obu_id"),
             "data_type": L.ADJUSTMENT, "adjust_type": L.DECREASE, "segment": L.BUS,
             "scene2": "q2_bus_bank_first_use", "net_price": 0, "month": ADJUSTMENT_MONTH}, MERGED),
        # as loaded, with a month of its own
        "as_loaded": ledger_shaped(inputs["loaded_corrections"], MERGED),
    }


def merge_ledger(spark: SparkSession, inputs, ctx: RunContext, truck: DataFrame, bus: DataFrame,
                 window: bool = True) -> DataFrame:
    """All partitions that the run writes, whole, with the arm that each adjustment
    comes from.

    The window is on the date; a correction may be dated inside it and still name an
    older month.  Such rows join the rows that their older partition already has,
    without those that an earlier run of the same window put there: the stored arm and
    a date in the window tell them from rows that were booked, however equal they are.
    So writing the partition loses nothing, and a second run changes nothing.

    A rebuild owns its months and, of older ones, corrections dated from its first
    month on.  The adjustments are staged once (a run's window, or all for a rebuild);
    truck and bus rows take their month from their date and are never late."""
    arms = merge_arms(spark, truck, bus, inputs)
    taxed = lambda df: df.withColumn("net_price", net_price(F.col("segment"), F.col("scene"), F.col("price")))
    stored = lambda df, arm: df.select(*MERGED.fieldNames()[:-1], F.lit(arm).cast("string").alias(ARM), "month")
    booked = union_feeds([stored(arms.pop(n), None) for n in ("truck", "bus")])
    adjusted = union_feeds([stored(df, name) for name, df in arms.items()])
    first = ctx.window_start if window else ctx.rebuild_months[0]
    dated = month_from(adjusted, "date", first)
    own = F.col("month") >= F.lit(first)
    if window:
        # booked rows take their month from their date: the month prunes partitions
        booked, adjusted = rewrite_window(booked.where(own), ctx), adjusted.where(dated)
    else:
        booked, adjusted = booked.where(own), adjusted.where(own | dated)
    adjusted = staged(taxed(adjusted))
    late = adjusted.where(~own)
    months = sorted(r["month"] for r in late.select("month").distinct().collect())  # older months that corrections name
    parts = [taxed(booked), adjusted]
    if months:
        current = inputs["current_ledger"]
        arm = F.col(ARM) if ARM in current.columns else F.lit(None)
        held = current.where(F.col("month").isin(months)).select(*MERGED.fieldNames()[:-1], arm.cast("string").alias(ARM), "month")
        replaced = F.col(ARM).isNotNull() & F.coalesce(month_from(held, "date", first), F.lit(False))
        parts.append(ledger_shaped(held.where(~replaced), STORED))
    return union_feeds(parts)


def empty_ledger(spark: SparkSession) -> DataFrame:
    """The ledger before its first run."""
    return spark.createDataFrame([], STORED)


def with_net_price(ledger: DataFrame) -> DataFrame:
    """P15 alone: ledger rows in the merged schema with their after-tax price."""
    values = {c: f"@{c}" for c in LEDGER.fieldNames()}
    values["net_price"] = net_price(F.col("segment"), F.col("scene"), F.col("price"))
    return conform(ledger, values, MERGED)
