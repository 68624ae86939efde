from ledgerline.sources.tables import load_table
from ledgerline.sources.snapshot import (
    at_snapshot,
    closed_months,
    month_in,
    month_of,
    month_to_date,
    snapshot_union,
    today,
)

__all__ = [
    "load_table",
    "today",
    "month_to_date",
    "closed_months",
    "at_snapshot",
    "snapshot_union",
    "month_of",
    "month_in",
]
