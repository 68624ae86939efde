"""Registered queries: one Spark builder and one DuckDB oracle per key.

Each builder takes ``(spark, root)`` (root = folder of the test tables) and
returns a lazy DataFrame over whole tables.  Each oracle is independent SQL
over the same tables, with the fixture views inlined as CTEs.  Importing the
area modules registers their queries (in this order).
"""

from ledgerline.registry.base import DATE_OUTPUTS, MID_MONTH, MONTH_CLOSE, ORACLE, QUERIES, register
from ledgerline.registry import snapshots, ledgers, reports, services, cost, sinks  # noqa: F401  (registers the queries)
from ledgerline.registry.cost import COST_DAY

__all__ = ["QUERIES", "ORACLE", "DATE_OUTPUTS", "MID_MONTH", "MONTH_CLOSE", "COST_DAY", "register"]
