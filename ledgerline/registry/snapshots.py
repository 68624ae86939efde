"""Snapshot slices: month-to-date, month close, rebuild, pinned snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.context import RunContext
from ledgerline.oracle import snapshot_arms, two_arm, window_filter
from ledgerline.registry.base import MID_MONTH, MONTH_CLOSE, register
from ledgerline.sources import fixtures as fx
from ledgerline.sources.snapshot import at_snapshot, month_in, snapshot_union


def _snapshot_rows(df: DataFrame) -> DataFrame:
    return df.select(
        F.to_date("event_ts").alias("date"), F.col("bank").alias("buyer"),
        F.col("price").cast("double").alias("price"), F.col("id").alias("obu_id"),
    ).distinct()


def _snapshot_sql(ctx: RunContext, window: bool) -> str:
    sel = "CAST(event_ts AS DATE) AS date, bank AS buyer, CAST(price AS DOUBLE) AS price, id AS obu_id"
    body = two_arm(sel, floor=ctx.floor_month)
    outer = f" WHERE {window_filter(ctx)}" if window else ""
    return fx.with_fixtures(f"SELECT * FROM ({body}) t{outer}", ["fx_snapshot"], snapshot_arms(ctx))


@register("snapshot_mtd", _snapshot_sql(MID_MONTH, window=True))
def snapshot_mtd(spark: SparkSession, root: str) -> DataFrame:
    """Month-to-date rows of today's snapshot, deduplicated."""
    snap = fx.fx_snapshot(spark, root)
    return _snapshot_rows(snapshot_union(snap, "event_ts", MID_MONTH, mode="incremental"))


@register("snapshot_month_close", _snapshot_sql(MONTH_CLOSE, window=True))
def snapshot_month_close(spark: SparkSession, root: str) -> DataFrame:
    """On the 1st, the closing month and the new month, one snapshot."""
    snap = fx.fx_snapshot(spark, root)
    return _snapshot_rows(snapshot_union(snap, "event_ts", MONTH_CLOSE, mode="incremental"))


@register("snapshot_rebuild", _snapshot_sql(MONTH_CLOSE, window=False))
def snapshot_rebuild(spark: SparkSession, root: str) -> DataFrame:
    """S4, S5 rebuild mode, F2: every closed month since the first close."""
    snap = fx.fx_snapshot(spark, root)
    return _snapshot_rows(snapshot_union(snap, "event_ts", MONTH_CLOSE, mode="rebuild"))


@register("snapshot_pinned", fx.with_fixtures(
    "SELECT DISTINCT CAST(event_ts AS DATE) AS date, bank AS buyer, CAST(price AS DOUBLE) AS price, "
    "CAST(vehicle_id AS VARCHAR) AS obu_id FROM fx_snapshot WHERE ds = '20010701' "
    "AND strftime(event_ts, '%Y-%m') BETWEEN '2001-03' AND '2001-05'", ["fx_snapshot"]))
def snapshot_pinned(spark: SparkSession, root: str) -> DataFrame:
    """A pinned historic snapshot, closed month range, distinct."""
    snap = fx.fx_snapshot(spark, root)
    x = at_snapshot(snap, "20010701")
    x = x.where(month_in(snap, "event_ts", "2001-03", "2001-05"))
    return x.select(
        F.to_date("event_ts").alias("date"), F.col("bank").alias("buyer"),
        F.col("price").cast("double").alias("price"), F.col("vehicle_id").cast("string").alias("obu_id"),
    ).distinct()
