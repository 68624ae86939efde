"""Snapshot slices.

A snapshot table holds one full copy of the business state per day in a
string partition ``ds='yyyyMMdd'``.  A feed reads

* the month-to-date rows of today's snapshot (S3), and
* for every closed month, the rows of that month in the snapshot taken on the
  1st of the following month (S4),

then deduplicates.  ``snapshot_union`` does both in ONE scan with an OR-ed
predicate.  In incremental mode it reads only today's snapshot: the outer
rewrite window (month of yesterday .. month of today) can only contain rows of
today's snapshot, because a closed month closes from the snapshot taken on the
1st, which is today's when the window reaches back a month.  Event-month
predicates are written as typed ranges on the raw column so they reach the
Parquet scan as pushed filters; ``ds`` predicates become partition filters.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.context import RunContext, add_months


def month_of(c: Column | str) -> Column:
    """``yyyy-MM`` of a date, timestamp or timestamp-looking string."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM")


def _month_start(month: str) -> date:
    return date(int(month[:4]), int(month[5:7]), 1)


def _bound(df: DataFrame, column: str, d: date) -> Column:
    """Literal ``d`` typed like ``df[column]`` (so the comparison is pushable)."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        return F.lit(d.strftime("%Y-%m-%d"))
    if isinstance(dtype, T.DateType):
        return F.lit(d)
    return F.lit(d.strftime("%Y-%m-%d 00:00:00")).cast(dtype)


def month_in(df: DataFrame, column: str, first: str, last: str) -> Column:
    """``first <= month(column) <= last`` as a half-open range on the raw column."""
    lo = _bound(df, column, _month_start(first))
    hi = _bound(df, column, add_months(_month_start(last), 1))
    c = F.col(column)
    return (c >= lo) & (c < hi)


def month_from(df: DataFrame, column: str, first: str) -> Column:
    """``month(column) >= first`` (the feed floor, F2)."""
    return F.col(column) >= _bound(df, column, _month_start(first))


def today(df: DataFrame, ctx: RunContext, ds: str = "ds") -> DataFrame:
    """today's snapshot."""
    return df.where(F.col(ds) == F.lit(ctx.ds))


def at_snapshot(df: DataFrame, day: str, ds: str = "ds") -> DataFrame:
    """A pinned historic snapshot."""
    return df.where(F.col(ds) == F.lit(day))


def month_to_date(df: DataFrame, event: str, ctx: RunContext, ds: str = "ds") -> DataFrame:
    """S3: rows of the current month in today's snapshot."""
    return df.where((F.col(ds) == F.lit(ctx.ds)) & month_in(df, event, ctx.month, ctx.month))


def _closed_predicate(df: DataFrame, event: str, ctx: RunContext, ds: str) -> Column:
    """Snapshots taken on a 1st, from the first close up to the run date
    (closes after ``as_of`` are ignored, so a back-dated run sees the data as
    it was on that day), each contributing the month before it."""
    d = F.col(ds)
    closes = (F.substring(d, 7, 2) == F.lit("01")) & (d >= F.lit(ctx.first_close)) & (d <= F.lit(ctx.ds))
    # the month before the snapshot day, as a typed range on the raw event
    # column: [1st of previous month, snapshot day) -- no per-row formatting
    day = F.to_date(d, "yyyyMMdd")
    dtype = df.schema[event].dataType
    lo, hi = F.add_months(day, -1), day
    if not isinstance(dtype, T.DateType):
        lo, hi = (lo.cast("string"), hi.cast("string")) if isinstance(dtype, T.StringType) else (lo.cast(dtype), hi.cast(dtype))
    e = F.col(event)
    return closes & (e >= lo) & (e < hi)


def closed_months(df: DataFrame, event: str, ctx: RunContext, ds: str = "ds") -> DataFrame:
    """Each closed month from the snapshot taken on the 1st after it."""
    return df.where(_closed_predicate(df, event, ctx, ds))


def snapshot_union(
    df: DataFrame,
    event: str,
    ctx: RunContext,
    mode: str = "incremental",
    ds: str = "ds",
    floor: bool = True,
) -> DataFrame:
    """Month-to-date of today plus closed months, in one scan.

    mode="incremental": only the months an incremental run rewrites
    (``ctx.window_start`` .. ``ctx.month``); reads today's snapshot only.
    mode="rebuild": every closed month since ``ctx.first_close`` plus the
    current month; one scan with an OR-ed predicate.
    Deduplication is left to the caller (after projection), since some feeds
    keep duplicates.
    """
    if mode == "incremental":
        pred = (F.col(ds) == F.lit(ctx.ds)) & month_in(df, event, ctx.window_start, ctx.month)
    elif mode == "rebuild":
        today_pred = (F.col(ds) == F.lit(ctx.ds)) & month_in(df, event, ctx.month, ctx.month)
        pred = today_pred | _closed_predicate(df, event, ctx, ds)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    if floor and ctx.floor_month:
        pred = pred & month_from(df, event, ctx.floor_month)
    return df.where(pred)


def movement_slice(df: DataFrame, ctx: RunContext, times: list[str], mode: str, months: list[str] | None = None,
                   ds: str = "ds") -> DataFrame:
    """Rows of a movement table that a run can need: one snapshot for an incremental
    run, the closing snapshots for a rebuild; of these, rows with any of their times on
    or after the first month the run owns.  All ranges are on raw columns and reach the
    scan.  A rebuild whose months lack a snapshot raises: those months cannot be built
    and must stay as they are."""
    if mode == "incremental":
        first, wanted = ctx.window_start, F.col(ds) == F.lit(ctx.ds)
    elif mode == "rebuild":
        owned = months or ctx.rebuild_months
        days = sorted({ctx.closing_ds(m) for m in owned})
        have = {r[0] for r in df.where(F.col(ds).isin(days)).select(ds).distinct().collect()}  # one row a month
        if missing := [m for m in owned if ctx.closing_ds(m) not in have]:
            raise ValueError(f"no snapshot closes {', '.join(missing)}; these months cannot be rebuilt")
        first, wanted = min(owned), F.col(ds).isin(days)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    late = None
    for t in times:
        late = month_from(df, t, first) if late is None else late | month_from(df, t, first)
    return df.where(wanted & late)
