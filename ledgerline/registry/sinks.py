"""Sinks, each written to a fresh table under the shared checkpoint folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline import sinks as K
from ledgerline.oracle import both_arms
from ledgerline.plans import cost as C, reports as R
from ledgerline.plans.inputs import fixture_inputs
from ledgerline.plans.truck import truck_ledger
from ledgerline.registry.base import MONTH_CLOSE, register
from ledgerline.registry.cost import COST_DAY, _COST_CTE, _cost_detail, _COST_FX, _DEPOSIT_BODY, _EXTRACT_SQL
from ledgerline.registry.ledgers import _truck_body
from ledgerline.registry.reports import _L_COLS, _WAIVER_SQL
from ledgerline.schema import LEDGER, conform, for_compare
from ledgerline.session import scratch_path
from ledgerline.sources import fixtures as fx


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


@register("overwrite_partitions", fx.with_fixtures(
    f"""SELECT date, scene, buyer, CAST(price AS DOUBLE) AS price, preinstall, obu_id, data_type, adjust_type, segment,
       scene2, month
FROM (SELECT {_L_COLS} FROM fx_ledger WHERE month NOT IN ('2001-07', '2001-08')
      UNION ALL
      SELECT {_L_COLS} FROM ({_truck_body(MONTH_CLOSE)}) t WHERE date >= DATE '2001-07-01') u""",
    ["fx_snapshot", "fx_after_sales", "fx_equipment", "fx_ledger"], both_arms(MONTH_CLOSE)))
def overwrite_partitions(spark: SparkSession, root: str) -> DataFrame:
    """K7 + K2: create a month-partitioned ledger, then an incremental run
    replaces only its window months; every other month survives."""
    name = _table_name("ledger")
    base = conform(fx.fx_ledger(spark, root), {c: f"@{c}" for c in LEDGER.fieldNames()}, LEDGER)
    K.create_partitioned(base, name, "month", path=scratch_path(spark, name))
    run = truck_ledger(fixture_inputs(spark, root), MONTH_CLOSE)
    K.overwrite_partitions(run, name, "month", clear=MONTH_CLOSE.window_months)
    return for_compare(spark.table(name))


@register("replace_day", fx.with_fixtures(_DEPOSIT_BODY, ["fx_accounts", "fx_wallet"]))
def replace_day(spark: SparkSession, root: str) -> DataFrame:
    """K3 + K4: the day's deposit totals written twice leave one copy."""
    name = _table_name("deposits")
    i = fixture_inputs(spark, root)
    day = COST_DAY.yesterday.strftime("%Y%m%d")
    path = scratch_path(spark, name)
    for _ in range(2):
        K.replace_day(C.deposit_totals(i["accounts"], i["wallet"], COST_DAY), name, day, path=path)
    return spark.table(name)


@register("full_refresh", _WAIVER_SQL)
def full_refresh(spark: SparkSession, root: str) -> DataFrame:
    """K1: a summary table fully replaced twice holds one copy."""
    name = _table_name("waiver_summary")
    path = scratch_path(spark, name)
    for _ in range(2):
        K.full_refresh(R.waiver_summary(fx.fx_ledger(spark, root)), name, path=path)
    return spark.table(name)


@register("extract_csv", fx.with_fixtures(_EXTRACT_SQL, _COST_FX, _COST_CTE))
def extract_csv(spark: SparkSession, root: str) -> DataFrame:
    """K6: the daily cost extract written as CSV (parallel, with header) and
    read back with its declared schema."""
    df = for_compare(C.daily_extract(_cost_detail(spark, root), COST_DAY))
    path = scratch_path(spark, "extract")
    K.extract_csv(df, path)
    return spark.read.option("header", "true").schema(df.schema).csv(path)
