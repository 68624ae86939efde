"""Reports kept per month and rewritten only where a run changed something.

The enriched ledger and the partial sums of its summary are partitioned by the ledger's
month, the waiver counts by the month of their date.  A run rewrites

* the months that it wrote in the ledger, and
* months with rows whose result depends on what changed elsewhere: devices whose channel
  membership or name is new, and (device, buyer) pairs that were waived or no longer are.

To know the latter, the dimension and the waived pairs of the last run are kept, and the
difference of both versions is joined with two columns of the ledger.  Where nothing of
that kind changed, no partition but the run's own is read.  The published summaries are
merged from the partial sums, which are a small share of the ledger.

The kept versions are written last: a run that fails before sees the same differences
again, and repeats work instead of missing it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.functions.department import department
from ledgerline.functions.geo import province
from ledgerline.operators.joins import attach_dimensions, staged
from ledgerline.plans import reports as R
from ledgerline.sinks import create_partitioned, full_refresh, overwrite_partitions
from ledgerline.sources.snapshot import month_of

SUMMARY_KEYS = ["date", "scene", "buyer", "preinstall", "data_type", "adjust_type", "segment", "scene2", "department", "province", "price"]
WAIVER_KEYS = ["date", "province", "buyer", "mark"]


@dataclass
class ReportTables:
    """Published tables, and those that the next run reads."""

    enriched: str
    summary: str
    waiver: str

    def kept(self, name: str) -> str:
        return {"summary_parts": f"{self.summary}_parts", "waiver_parts": f"{self.waiver}_parts",
                "devices": f"{self.enriched}_devices", "waived": f"{self.waiver}_pairs"}[name]


def device_dimension(members: DataFrame, device: DataFrame) -> DataFrame:
    """One row per device: whether it was sold through the channel, and its latest name."""
    a = members.select("device", F.lit(True).alias("in_channel"), F.lit(None).cast("string").alias("openname"))
    b = device.select(F.col("obuid").alias("device"), F.lit(False).alias("in_channel"), "openname")
    both = a.unionByName(b).where("device is not null")
    return both.groupBy("device").agg(F.max("in_channel").alias("in_channel"), F.max("openname").alias("openname"))


def enrich_from(ledger: DataFrame, devices: DataFrame) -> DataFrame:
    """D7 from the one-row-per-device dimension."""
    c = F.col
    x = attach_dimensions(ledger, "obu_id", [(devices, "device", {"__in_channel": F.max("in_channel"), "openname": F.max("openname")})])
    inside = F.coalesce(c("__in_channel"), F.lit(False))
    return x.select(*ledger.columns, department(c("segment"), c("scene"), inside, c("openname")).alias("department"), province(c("obu_id")).alias("province"))


def differing(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two sets has."""
    return new.exceptAll(old).unionByName(old.exceptAll(new))


def _months(df: DataFrame) -> set[str]:
    return {r[0] for r in df.distinct().collect() if r[0] is not None}  # one row a month


def summary_parts(enriched: DataFrame) -> DataFrame:
    """A3: counts and sums of the summary per ledger month; they add up over months."""
    keyed = enriched.withColumn("amount", F.col("price")).withColumn("price", F.col("price").cast("double"))
    return keyed.groupBy(*SUMMARY_KEYS, "month").agg(F.count("obu_id").alias("obu_amt"), F.sum("amount").alias("money")).select(*SUMMARY_KEYS, "obu_amt", "money", "month")


def merged_parts(parts: DataFrame) -> DataFrame:
    """D8 from its partial sums."""
    money = parts.schema["money"].dataType
    return parts.groupBy(*SUMMARY_KEYS).agg(F.sum("obu_amt").alias("obu_amt"), F.sum("money").cast(money).alias("money"))


def waived_pairs(ledger: DataFrame) -> DataFrame:
    truck = F.col("segment") == F.lit(L.TRUCK)
    return ledger.where(truck & (F.col("scene2") == F.lit(R.WAIVER_ROWS))).where("obu_id is not null and buyer is not null").select("obu_id", "buyer", "month").distinct()


def waiver_parts(ledger: DataFrame, pairs: DataFrame) -> DataFrame:
    """D6 for the given rows, with the month of the date."""
    counted = R.waiver_counts(R.waiver_devices(ledger), pairs.select("obu_id", "buyer"))
    return counted.withColumn("month", month_of("date"))


def _replace(df: DataFrame, table: str, months: set[str] | None, location: str | None) -> None:
    if months is None or not df.sparkSession.catalog.tableExists(table):
        create_partitioned(df, table, "month", path=location)
    else:
        overwrite_partitions(df, table, clear=sorted(months))


def refresh_reports(spark: SparkSession, ledger: DataFrame, members: DataFrame, device: DataFrame, tables: ReportTables,
                    written: list[str] | None = None, locations: dict | None = None) -> dict[str, list[str]]:
    """Bring the reports up to date with ``ledger`` after a run that wrote the months
    ``written`` (None: all, a full refresh).  Returns the months that were rewritten."""
    loc = (locations or {}).get
    names = {n: tables.kept(n) for n in ("summary_parts", "waiver_parts", "devices", "waived")}
    known = all(spark.catalog.tableExists(t) for t in (*names.values(), tables.enriched))
    full = written is None or not known
    own = None if full else set(written)

    # Months written, and those of devices whose dimension row changed
    devices = staged(device_dimension(members, device))
    months = own
    if not full:
        changed = staged(differing(spark.table(names["devices"]), devices).select(F.col("device").alias("obu_id")).distinct())
        if not changed.isEmpty():
            months = own | _months(ledger.select("obu_id", "month").join(changed, "obu_id", "left_semi").select("month"))
    inside = lambda df, m: df if m is None else df.where(F.col("month").isin(sorted(m)))
    _replace(enrich_from(inside(ledger, months), devices), tables.enriched, months, loc("enriched"))
    _replace(summary_parts(inside(spark.table(tables.enriched), months)), names["summary_parts"], months, loc("summary_parts"))
    full_refresh(merged_parts(spark.table(names["summary_parts"])), tables.summary, path=loc("summary"))

    # Dates of the months written, and of devices that were waived or no longer are
    dates = own
    mine = waived_pairs(inside(ledger, own))
    if full:
        pairs = mine
        rows = ledger
    else:
        old = spark.table(names["waived"])
        pairs = staged(old.where(~F.col("month").isin(sorted(own))).unionByName(mine.select(*old.columns)))
        moved = staged(differing(old.select("obu_id", "buyer").distinct(), pairs.select("obu_id", "buyer").distinct()).distinct())
        rows = inside(ledger, own)
        if not moved.isEmpty():
            touched = _months(R.waiver_devices(ledger).join(moved, ["obu_id", "buyer"], "left_semi").select(month_of("date")))
            if touched - own:
                dates, rows = own | touched, ledger
        # rows of the window's dates lie in the months written; for other dates every month is read
        rows = rows.where(month_of("date").isin(sorted(dates)))
    _replace(waiver_parts(rows, pairs), names["waiver_parts"], dates, loc("waiver_parts"))
    full_refresh(spark.table(names["waiver_parts"]).select(*WAIVER_KEYS, "amt"), tables.waiver, path=loc("waiver"))

    # what the next run compares with
    full_refresh(devices, names["devices"], path=loc("devices"))
    _replace(pairs, names["waived"], None if full else own, loc("waived"))
    shown = lambda m: sorted(m) if m is not None else sorted(_months(ledger.select("month")))
    return {"enriched": shown(months), "waiver": shown(dates)}
