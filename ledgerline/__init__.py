"""Spark-native revenue-ledger and unit-cost analytics.

Everything here builds lazy DataFrames with the DataFrame API so that
Catalyst pushes filters to the Parquet scans, prunes columns and picks join
strategies at run time (AQE).  Sinks are the only functions with side effects.

The public API is re-exported here; see the sub-packages for details.
"""

from ledgerline.context import RunContext
from ledgerline.functions.cost import channel_cost, deposit_interest, partner_cost, profit
from ledgerline.functions.department import department
from ledgerline.functions.geo import province
from ledgerline.functions.rules import (
    direction,
    effective_rate,
    keep,
    not_blank,
    not_in,
    not_like,
    ordered_rule,
    recode,
)
from ledgerline.functions.tax import net_price
from ledgerline.operators.adjustments import adjustment, constant_rows, ledger_shaped, self_correction
from ledgerline.operators.aggregate import monthly_flows, summarise
from ledgerline.operators.feeds import FeedSpec, build_feed, rewrite_window, union_feeds
from ledgerline.operators.joins import (
    attach_dimensions,
    attach_one_per_key,
    flag_existence,
    resolve_id,
    restrict_to_keys,
    spread_null_key,
)
from ledgerline.operators.lookup import equality_rule, prefix_rule, rate_from_table
from ledgerline.operators.movements import MovementSpec, expand_movements
from ledgerline.plans.jobs import CostTables, IncomeTables, run_cost_job, run_income_job
from ledgerline.schema import LEDGER, MERGED, MOVEMENT, check_schema, conform
from ledgerline.sinks import (
    create_partitioned,
    extract_csv,
    full_refresh,
    overwrite_partitions,
    publish_jdbc,
    replace_day,
)
from ledgerline.sources.snapshot import at_snapshot, closed_months, month_to_date, snapshot_union, today
from ledgerline.sources.tables import load_table

__all__ = [
    "RunContext", "LEDGER", "MERGED", "MOVEMENT", "conform", "check_schema",
    "load_table", "today", "month_to_date", "closed_months", "at_snapshot", "snapshot_union",
    "FeedSpec", "build_feed", "union_feeds", "rewrite_window",
    "ledger_shaped", "adjustment", "constant_rows", "self_correction",
    "restrict_to_keys", "flag_existence", "attach_one_per_key", "attach_dimensions", "resolve_id", "spread_null_key",
    "equality_rule", "prefix_rule", "rate_from_table",
    "MovementSpec", "expand_movements", "summarise", "monthly_flows",
    "ordered_rule", "keep", "recode", "direction", "effective_rate", "not_in", "not_like", "not_blank",
    "net_price", "province", "department", "partner_cost", "channel_cost", "profit", "deposit_interest",
    "full_refresh", "create_partitioned", "overwrite_partitions", "replace_day", "publish_jdbc", "extract_csv",
    "IncomeTables", "CostTables", "run_income_job", "run_cost_job",
]
