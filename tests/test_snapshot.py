"""Snapshot slices: the one-scan incremental form equals the modelled
two-arm form restricted to the rewrite window, for many run dates."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.context import RunContext
from ledgerline.sources.snapshot import closed_months, month_to_date, snapshot_union


@pytest.fixture(scope="module")
def daily_snapshots(spark):
    """A small table with one full snapshot per day (tests only): every event
    appears in every snapshot taken on or after its day."""
    start = date(2001, 5, 20)
    days = [start + timedelta(days=i) for i in range(75)]
    events = [(f"e{i}", start + timedelta(days=(i * 7) % 75), 10 + i % 5) for i in range(60)]
    rows = [(e, ev, p, d.strftime("%Y%m%d")) for d in days for (e, ev, p) in events if ev <= d]
    df = spark.createDataFrame(rows, "id string, event date, price int, ds string")
    return df.withColumn("event_ts", F.col("event").cast("timestamp_ntz")).drop("event").cache()


def _rows(df):
    return sorted(tuple(r) for r in df.select("id", F.to_date("event_ts").alias("d"), "price").distinct().collect())


RUN_DAYS = [date(2001, 6, 1), date(2001, 6, 2), date(2001, 6, 15), date(2001, 6, 30), date(2001, 7, 1),
            date(2001, 7, 2), date(2001, 7, 31), date(2001, 8, 1), date(2001, 8, 2)]


@pytest.mark.parametrize("as_of", RUN_DAYS, ids=str)
def test_incremental_equals_two_arm_form_in_window(daily_snapshots, as_of):
    ctx = RunContext(as_of=as_of, first_close="20010601", floor_month=None)
    df = daily_snapshots
    inc = _rows(snapshot_union(df, "event_ts", ctx, mode="incremental"))
    two_arm = month_to_date(df, "event_ts", ctx).unionByName(closed_months(df, "event_ts", ctx))
    window = two_arm.where(F.date_format("event_ts", "yyyy-MM") >= ctx.window_start)
    assert inc == _rows(window)


@pytest.mark.parametrize("as_of", [date(2001, 7, 1), date(2001, 7, 20), date(2001, 8, 1)], ids=str)
def test_rebuild_equals_two_arm_form(daily_snapshots, as_of):
    ctx = RunContext(as_of=as_of, first_close="20010601", floor_month=None)
    df = daily_snapshots
    reb = _rows(snapshot_union(df, "event_ts", ctx, mode="rebuild"))
    two_arm = month_to_date(df, "event_ts", ctx).unionByName(closed_months(df, "event_ts", ctx))
    assert reb == _rows(two_arm)


def test_window_months():
    assert RunContext(as_of=date(2001, 8, 1)).window_months == ["2001-07", "2001-08"]
    assert RunContext(as_of=date(2001, 8, 2)).window_months == ["2001-08"]
    # before the first close nothing older is rewritten
    assert RunContext(as_of=date(2001, 5, 1), first_close="20010601").window_months == ["2001-05"]


def test_string_and_timestamp_event_columns_slice_alike(daily_snapshots):
    ctx = RunContext(as_of=date(2001, 8, 1), first_close="20010601", floor_month="2001-05")
    as_text = daily_snapshots.withColumn("event_ts", F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"))
    for mode in ("incremental", "rebuild"):
        a = sorted(tuple(r) for r in snapshot_union(daily_snapshots, "event_ts", ctx, mode=mode)
                   .select("id", "ds").collect())
        b = sorted(tuple(r) for r in snapshot_union(as_text, "event_ts", ctx, mode=mode).select("id", "ds").collect())
        assert a == b and len(a) > 0
    assert closed_months(as_text, "event_ts", ctx).count() == closed_months(daily_snapshots, "event_ts", ctx).count()
