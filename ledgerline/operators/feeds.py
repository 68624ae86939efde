"""Feeds: one declarative spec per source, built into ledger rows.

A ``FeedSpec`` says where a feed reads (snapshot slice, today only, or a
plain table), which rows it keeps and how each ledger column is computed.
``build_feed`` turns it into a lazy DataFrame; ``union_feeds`` stacks feeds by
name.  Catalyst pushes each feed's predicates into its own scan and prunes
the columns it does not use.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import labels as L
from ledgerline.context import RunContext
from ledgerline.schema import LEDGER, conform
from ledgerline.sources.coverage import require
from ledgerline.sources.snapshot import month_from, snapshot_union, today


@dataclass
class FeedSpec:
    """One feed.  ``source`` names the input; ``event`` is the event column
    the slice and the floor use, ``event_column`` its name in the source if that
    differs; ``segment`` .. ``key`` give the ledger fields
    (a Column, a literal, or ``"@col"``); ``slice`` is ``snapshot`` (today's
    month-to-date plus closed months), ``today`` (today's snapshot only) or
    ``table`` (a plain table); ``distinct`` deduplicates the conformed rows;
    ``floor`` applies the context's lowest month; ``where`` filters the source."""

    name: str
    source: str
    event: str
    segment: str
    scene2: object
    scene: object
    buyer: object
    price: object
    key: object
    preinstall: object = None
    data_type: object = L.RECEIVABLE
    adjust_type: object = L.RECEIVABLE
    date: object = None  # default: to_date(event)
    slice: str = "snapshot"  # snapshot | today | table
    distinct: bool = True
    floor: bool = True
    where: Column | None = None
    # deduplicate on the raw event value (a feed that keeps time of day in
    # its key), then cast; default: cast to date first, as most feeds do
    dedup_raw_event: bool = False
    event_column: str | None = None


def build_feed(spec: FeedSpec, df: DataFrame, ctx: RunContext, mode: str = "incremental",
               window: bool = False) -> DataFrame:
    """``window=True``: the caller applies the rewrite window (F1) to this
    feed; it is also given to the scan as a typed range on the raw event
    column so non-snapshot sources skip old row groups (snapshot slices are
    already bounded by month)."""
    if spec.event_column:
        df = df.withColumnRenamed(spec.event_column, spec.event)
    if spec.slice != "snapshot" and window:
        df = df.where(month_from(df, spec.event, ctx.window_start))
    if spec.slice == "snapshot":
        x = snapshot_union(df, spec.event, ctx, mode=mode, floor=spec.floor)
    elif spec.slice == "today":
        x = today(df, ctx)
        if spec.floor and ctx.floor_month:
            x = x.where(month_from(df, spec.event, ctx.floor_month))
    elif spec.slice == "table":
        x = df
        if spec.floor and ctx.floor_month:
            x = x.where(month_from(df, spec.event, ctx.floor_month))
    else:
        raise ValueError(spec.slice)
    if spec.where is not None:
        x = x.where(spec.where)
    values = {
        "date": spec.date if spec.date is not None else F.col(spec.event),
        "scene": spec.scene,
        "buyer": spec.buyer,
        "price": spec.price,
        "preinstall": spec.preinstall,
        "obu_id": spec.key,
        "data_type": spec.data_type,
        "adjust_type": spec.adjust_type,
        "segment": spec.segment,
        "scene2": spec.scene2,
    }
    if spec.distinct and spec.dedup_raw_event:
        raw = x.select("*", F.col(spec.event).alias("__raw_event"))
        out = conform(raw, {**values, "__raw_event": F.col("__raw_event")}, _with_raw(raw))
        return out.distinct().drop("__raw_event")
    out = conform(x, values, LEDGER)
    return out.distinct() if spec.distinct else out


def own_sources(specs: list[FeedSpec], events: dict[str, str]) -> list[FeedSpec]:
    """Snapshot feeds each read a table of their own, named after the feed, with the
    event column that ``events`` gives."""
    return [replace(s, source=s.name, event_column=events[s.name]) if s.source == "snapshot" else s for s in specs]


def snapshot_feeds(specs: list[FeedSpec]) -> dict[str, str]:
    """The feeds that read snapshots, and the input of each."""
    return {s.name: s.source for s in specs if s.slice != "table"}


def feed_ledger(specs: list[FeedSpec], inputs, ctx: RunContext, mode: str = "incremental", months: list[str] | None = None) -> DataFrame:
    """All feeds of a ledger, stacked.  A rebuild (of ``months``, or all) raises
    ``MissingSnapshots`` where a feed's source lacks a closing snapshot."""
    if mode == "rebuild":
        spark = inputs[specs[0].source].sparkSession
        require(spark, inputs, snapshot_feeds(specs), ctx, mode, months)
    out = union_feeds([build_feed(s, inputs[s.source], ctx, mode, window=(mode == "incremental")) for s in specs])
    return rewrite_window(out, ctx) if mode == "incremental" else out


def _with_raw(df: DataFrame) -> T.StructType:
    return T.StructType(LEDGER.fields + [T.StructField("__raw_event", df.schema["__raw_event"].dataType)])


def union_feeds(frames: list[DataFrame]) -> DataFrame:
    """Stack conformed frames by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def rewrite_window(df: DataFrame, ctx: RunContext, column: str = "date") -> DataFrame:
    """keep the months an incremental run rewrites (lower bound only),
    as a typed comparison with the first day of the window."""
    return df.where(month_from(df, column, ctx.window_start))
