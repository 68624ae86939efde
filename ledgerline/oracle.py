"""Helpers for the DuckDB oracles of snapshot feeds.

An oracle spells out both arms of a snapshot feed (today's month to date, and
each closed month from the snapshot that closed it) instead of the one-scan
reduction the library uses, so the reduction itself is under test.
"""

from __future__ import annotations

from ledgerline.context import RunContext


def snapshot_arms(ctx: RunContext, table: str = "fx_snapshot", event: str = "event_ts", slices: str = "snap") -> str:
    """CTEs ``<slices>_today`` and ``<slices>_closed`` for one run context."""
    return (
        f"{slices}_today AS (SELECT * FROM {table} WHERE ds = '{ctx.ds}' "
        f"AND strftime({event}, '%Y-%m') = '{ctx.month}'),\n"
        f"{slices}_closed AS (SELECT * FROM {table} WHERE substr(ds, 7, 2) = '01' AND ds >= '{ctx.first_close}' "
        f"AND ds <= '{ctx.ds}' AND strftime({event}, '%Y-%m') = "
        f"strftime(strptime(ds, '%Y%m%d') - INTERVAL 1 MONTH, '%Y-%m'))"
    )


def both_arms(ctx: RunContext) -> str:
    """The slices of the snapshot and of the after-sales table."""
    return snapshot_arms(ctx) + ",\n" + snapshot_arms(ctx, "fx_after_sales", slices="after")


def two_arm(select_list: str, where: str | None = None, distinct: bool = True, floor: str | None = None,
            event: str = "event_ts", slices: str = "snap") -> str:
    """One feed: both arms with the same select list, each deduplicated."""
    d = "DISTINCT " if distinct else ""
    conds = [c for c in (where, f"strftime({event}, '%Y-%m') >= '{floor}'" if floor else None) if c]
    w = (" WHERE " + " AND ".join(f"({c})" for c in conds)) if conds else ""
    return (f"SELECT {d}{select_list} FROM {slices}_today{w}\n"
            f"UNION ALL\nSELECT {d}{select_list} FROM {slices}_closed{w}")


def window_filter(ctx: RunContext, column: str = "date") -> str:
    """F1 as SQL: month(column) >= month(as_of - 1 day)."""
    return f"strftime({column}, '%Y-%m') >= '{ctx.window_start}'"
