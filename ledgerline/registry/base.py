"""Query registry core: the register decorator, the query and oracle maps,
and the run dates the registered queries use."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerline.context import RunContext
from ledgerline.schema import for_compare


# fixed values: the two test run dates (mid-month, month close)
MID_MONTH = RunContext(as_of=date(2001, 7, 15))
MONTH_CLOSE = RunContext(as_of=date(2001, 8, 1))

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


# Output date columns per query (default: "date"); both sides present them
# as midnight timestamps (see schema.for_compare).
DATE_OUTPUTS = {
    "cost_bill_detail": ["bill_date"],
    "cost_detail_colocated": ["bill_date"],
    "cost_daily_extract": ["bill_date"],
    "cost_rate_table": ["bill_date"],
    "cost_bill_detail_pivot": ["bill_date"],
    "extract_csv": ["bill_date"],
    "daily_profit": ["bz_date"],
    "cost_semi_only": [],
    "deposit_totals": [],
    "replace_day": [],
    "monthly_debit_refund": [],
}


def _dates_as_timestamps(name: str, sql: str) -> str:
    cols = DATE_OUTPUTS.get(name, ["date"])
    if not cols:
        return sql
    repl = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) q"


def register(name: str, sql: str | None = None):
    def deco(fn):
        def query(spark: SparkSession, root: str) -> DataFrame:
            return for_compare(fn(spark, root))

        query.__name__, query.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = _dates_as_timestamps(name, sql)
        return fn

    return deco
