"""End-to-end jobs: every stage is written to a table and the next stage
reads that table back.  That cuts lineage at each stage (a lost executor
never recomputes earlier stages), mirrors how the modelled jobs hand data
between steps, and every write is repeatable (re-running a day gives the
same tables).

Dependency graph of the income job:
  truck (D1) + bus (D2) -> ledger (D4) -> settlement (D5), waiver (D6),
  enriched (D7) -> summary (D8); movements D9, D10, D11 are independent.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.context import RunContext
from ledgerline.plans import cost as C
from ledgerline.plans import reports as R
from ledgerline.plans import services as S
from ledgerline.plans.runlog import NoLog, RunLog
from ledgerline.operators.adjustments import admit
from ledgerline.operators.feeds import snapshot_feeds
from ledgerline.operators.joins import few_rows, hot_keys
from ledgerline.plans.bus import bus_ledger, bus_specs
from ledgerline.plans.inputs import Inputs
from ledgerline.plans.merge import empty_ledger, merge_ledger
from ledgerline.plans.summaries import ReportTables, refresh_reports
from ledgerline.plans.truck import truck_ledger, truck_specs
from ledgerline.schema import ARM, HAND_LOADED
from ledgerline.sinks import create_partitioned, extract_csv, full_refresh, overwrite_partitions, replace_day
from ledgerline.sources.coverage import require


@dataclass
class IncomeTables:
    truck: str = "dwd_truck_ledger"
    bus: str = "dwd_bus_ledger"
    ledger: str = "dwd_ledger"
    settlement: str = "dwd_settlement_slice"
    waiver: str = "dws_waiver_summary"
    enriched: str = "dwd_ledger_enriched"
    summary: str = "dws_ledger_summary"
    other: str = "dwd_other_movements"
    other_summary: str = "dws_other_movements"
    debit_refund: str = "dws_debit_refund"
    aftersales: str = "dwd_aftersales_movements"
    aftersales_summary: str = "dws_aftersales_movements"
    rejects: str = "dwd_rejected_rows"

    def prefixed(self, prefix: str) -> "IncomeTables":
        return IncomeTables(**{f.name: f"{prefix}{getattr(self, f.name)}" for f in fields(self)})


@dataclass
class CostTables:
    detail: str = "dwd_cost_detail"
    deposits: str = "dwd_deposits"
    profit: str = "dws_daily_profit"

    def prefixed(self, prefix: str) -> "CostTables":
        return CostTables(**{f.name: f"{prefix}{getattr(self, f.name)}" for f in fields(self)})


def write_months(df: DataFrame, table: str, ctx: RunContext, mode: str, partition_col: str = "month",
                 location: str | None = None, months: list[str] | None = None, older: bool = False) -> list[str] | None:
    """Month-partitioned target.  Every run replaces the months it has rows for and
    empties months of its own without rows; all other months stay as they are.  An
    incremental run's own months are its window; a rebuild's are all months that its
    snapshots close, or ``months`` (Q16: re-close a month whose run on the 1st was
    missed).  A rebuild writes no other month, unless ``df`` has older ones whole
    (``older``).  Returns the months that were replaced, None for a new table."""
    spark = df.sparkSession
    if mode == "rebuild" and (months or not older):
        df = df.where(F.col(partition_col).isin(months or ctx.rebuild_months))
    if not spark.catalog.tableExists(table):
        create_partitioned(df, table, partition_col, path=location)
        return None
    own = ctx.window_months if mode == "incremental" else (months or ctx.rebuild_months)
    return overwrite_partitions(df, table, partition_col, clear=own)


Publisher = Callable[[DataFrame, str], None]


def jdbc_publisher(url: str, properties: dict, schema: str = "public") -> Publisher:
    """K5: publish each summary table to a serving database (truncate + insert)."""
    from ledgerline.sinks import publish_jdbc

    return lambda df, table: publish_jdbc(df, url, f"{schema}.{table}", properties)


def _publish(spark: SparkSession, publish: Publisher | None, table: str) -> None:
    if publish is not None:
        publish(spark.table(table), table)


def income_snapshot_feeds() -> dict[str, str]:
    """Every feed of the income job that reads snapshots, and its input."""
    return snapshot_feeds(truck_specs()) | snapshot_feeds(bus_specs()) | {"D9_D11_movements": "service_detail"}


def admit_hand_loaded(inputs: Inputs, ctx: RunContext, table: str, location: str | None = None, write: Callable = lambda work: work()) -> Inputs:
    """The inputs with every hand-loaded table checked against its declared columns; what
    does not hold goes, with its reasons, to the run's day of ``table``."""
    checked = {n: admit(inputs[n], n, schema, required) for n, (schema, required) in HAND_LOADED.items()}
    rejects = reduce(lambda a, b: a.unionByName(b), [c.rejects for c in checked.values()])
    write(lambda: replace_day(rejects.withColumn("ds", F.lit(ctx.ds)), table, ctx.ds, partition_col="ds", path=location))
    return _Checked(inputs, {n: c.good for n, c in checked.items()})


class _Checked(Inputs):
    """Checked tables before the inputs they come from."""

    def __init__(self, inputs: Inputs, checked: dict):
        super().__init__(checked)
        self.inputs = inputs
        self.tables = inputs.tables

    def origin(self, name: str) -> str:
        return self.inputs.origin(name)

    def __missing__(self, name: str) -> DataFrame:
        return self.inputs[name]


def stored_ledger(spark: SparkSession, table: str) -> DataFrame:
    """The ledger that the job reads and rewrites; one written before arms were stored
    gets the column, null for all its rows."""
    if not spark.catalog.tableExists(table):
        return empty_ledger(spark)
    if ARM not in spark.table(table).columns:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ARM} string)")
    return spark.table(table)


def run_income_job(spark: SparkSession, inputs: Inputs, ctx: RunContext, tables: IncomeTables,
                   mode: str = "incremental", locations: dict | None = None,
                   publish: Publisher | None = None, months: list[str] | None = None, may_lack: tuple[str, ...] = (),
                   log: RunLog | None = None) -> None:
    """``publish`` (K5) receives every summary table after it was written.
    ``mode="rebuild", months=[...]`` re-closes only those months.

    ``log`` (a ``RunLog``) makes the job resumable: a run that failed goes on at the first
    stage that has not committed.

    Before the first table is touched, every snapshot source is checked for the
    snapshots that close the months the run owns; ``MissingSnapshots`` otherwise.
    Feeds in ``may_lack`` are left out of that check."""
    loc = (locations or {}).get
    feeds = {f: name for f, name in income_snapshot_feeds().items() if f not in may_lack}
    require(spark, inputs, feeds, ctx, mode, months)
    run = log or NoLog()
    inputs = admit_hand_loaded(inputs, ctx, tables.rejects, loc("rejects"), write=lambda work: run.stage("rejects", work))

    def monthly(name: str, build: Callable[[], DataFrame], table: str, **kw) -> list[str] | None:
        """A month-partitioned stage: the frame is built only if the stage runs."""
        return run.stage(name, lambda: write_months(build(), table, ctx, mode, location=loc(name), months=months, **kw))

    def whole(name: str, build: Callable[[], DataFrame], table: str) -> None:
        run.stage(name, lambda: full_refresh(build(), table, path=loc(name)))

    monthly("truck", lambda: truck_ledger(inputs, ctx, mode, months), tables.truck)
    monthly("bus", lambda: bus_ledger(inputs, ctx, mode, months), tables.bus)

    # the job reads its own target; before the first run there is no ledger
    inputs["current_ledger"] = stored_ledger(spark, tables.ledger)
    written = monthly("ledger", lambda: merge_ledger(spark, inputs, ctx, spark.table(tables.truck), spark.table(tables.bus), window=(mode == "incremental")),
                      tables.ledger, older=True)

    ledger = spark.table(tables.ledger).drop(ARM)
    whole("settlement", lambda: R.settlement_slice(ledger), tables.settlement)
    reports = ReportTables(tables.enriched, tables.summary, tables.waiver)

    def refresh() -> None:
        members = R.channel_members(inputs["external_channel"], inputs["shop_orders"], inputs["shop_serials"], inputs["shop_items"])
        refresh_reports(spark, ledger, members, inputs["device"], reports, written=written, locations=locations)

    run.stage("reports", refresh)

    monthly("other", lambda: S.other_movements(inputs["service_detail"], ctx, adjustments=inputs["other_adjustments"], mode=mode, months=months), tables.other)
    whole("other_summary", lambda: S.other_summary(spark.table(tables.other)), tables.other_summary)
    whole("debit_refund", lambda: S.debit_refund_totals(inputs["equipment"]), tables.debit_refund)
    monthly("aftersales", lambda: S.aftersales_movements(inputs["service_detail"], ctx, mode=mode, months=months), tables.aftersales)
    whole("aftersales_summary", lambda: S.aftersales_summary(spark.table(tables.aftersales)), tables.aftersales_summary)
    for table in (tables.waiver, tables.summary, tables.other_summary, tables.debit_refund, tables.aftersales_summary):
        run.stage(f"publish {table}", lambda table=table: _publish(spark, publish, table))
    run.finish()


def income_run_key(ctx: RunContext, mode: str = "incremental", months: list[str] | None = None) -> str:
    """What a run of the income job is resumed by."""
    return f"income {ctx.ds} {ctx.first_close} {mode} {' '.join(months or [])}".strip()


def run_cost_job(spark: SparkSession, inputs: Inputs, ctx: RunContext, tables: CostTables,
                 extract_path: str | None = None, locations: dict | None = None,
                 publish: Publisher | None = None) -> None:
    loc = (locations or {}).get
    hot = hot_keys(inputs["bill"], "statement_id")
    detail = C.bill_cost_detail(inputs["bill"], inputs["bill_lines"], inputs["settlement"], few_rows(inputs["product"]), hot=hot)
    full_refresh(detail, tables.detail, path=loc("detail"))
    day = ctx.yesterday.strftime("%Y%m%d")
    replace_day(C.deposit_totals(inputs["accounts"], inputs["wallet"], ctx), tables.deposits, day,
                path=loc("deposits"))
    full_refresh(C.daily_profit(spark.table(tables.detail), spark.table(tables.deposits)), tables.profit,
                 path=loc("profit"))
    _publish(spark, publish, tables.profit)
    if extract_path:
        extract_csv(C.daily_extract(spark.table(tables.detail), ctx), extract_path)
