"""Named inputs of the plans.

Plans take a mapping ``name -> DataFrame`` so the same plan runs on catalog
tables in production and on fixture views in tests.  ``fixture_inputs`` maps
every name to its fixture over the test tables (lazy; nothing is read here);
``catalog_inputs`` knows only the tables it was given and raises on any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.bus import BUS_EVENTS
from ledgerline.plans.merge import with_net_price
from ledgerline.plans.truck import TRUCK_EVENTS
from ledgerline.sources import fixtures as fx


def fixture_merged_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The ledger fixture as the merge writes it, with net prices."""
    return with_net_price(fx.fx_ledger(spark, root))


BUILDERS = {
    "snapshot": fx.fx_snapshot,
    "ledger_table": fx.fx_ledger,
    "live_adjustments": fx.fx_live_adjustments,
    "after_sales": fx.fx_after_sales,
    "service_detail": fx.fx_detail,
    "equipment": fx.fx_equipment,
    "bill": fx.fx_bill,
    "settlement": fx.fx_settlement,
    "product": fx.fx_product,
    "bill_lines": fx.fx_bill_lines,
    "accounts": fx.fx_accounts,
    "wallet": fx.fx_wallet,
    "external_channel": fx.fx_external_channel,
    "shop_orders": fx.fx_shop_orders,
    "shop_serials": fx.fx_shop_serials,
    "shop_items": fx.fx_shop_items,
    "device": fx.fx_device,
    "order_map": fx.fx_order_map,
    "corrections": fx.fx_corrections,
    "adjust_file": fx.fx_adjust_file,
    "manual_income": fx.fx_manual_income,
    "person_services": fx.fx_person_services,
    "person_scenes": fx.fx_person_scenes,
    "corrections_second": fx.fx_loaded_corrections,
    "loaded_corrections": fx.fx_loaded_corrections,
    "other_adjustments": fx.fx_other_adjustments,
    "current_ledger": fixture_merged_ledger,
}


# every snapshot feed reads a table of its own; its fixture is the snapshot, or for the
# after-sales feeds another one, under the feed's event column
FEED_EVENTS = TRUCK_EVENTS | BUS_EVENTS
AFTER_SALES_FEEDS = {"T5_after_sales", "T13_after_sales_decrease", "U4_after_sales", "U10_after_sales_decrease"}


class Inputs(dict):
    """Name -> DataFrame map of tables; an unknown name raises.  ``tables`` has the
    catalog table of the inputs that are read from one."""

    tables: dict[str, str] = {}

    def origin(self, name: str) -> str:
        """What an input is read from; inputs of one origin hold the same snapshots."""
        return self.tables.get(name, name)

    def __missing__(self, name: str) -> DataFrame:
        raise KeyError(f"input {name!r} was not given; known inputs: {', '.join(sorted(self)) or 'none'}")


class FixtureInputs(Inputs):
    """Lazily built, memoised fixtures over the test tables."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__()
        self.spark, self.root = spark, root
        self.built: set[str] = set()

    def origin(self, name: str) -> str:
        if name not in FEED_EVENTS or (name in self and name not in self.built):
            return name  # a frame that the caller put there is a table of its own
        return "after_sales" if name in AFTER_SALES_FEEDS else "snapshot"

    def __setitem__(self, name: str, frame: DataFrame) -> None:
        self.built.discard(name)
        super().__setitem__(name, frame)

    def __missing__(self, name: str) -> DataFrame:
        frame = BUILDERS[self.origin(name)](self.spark, self.root)
        if name in FEED_EVENTS:
            frame = frame.withColumnRenamed("event_ts", FEED_EVENTS[name])
        self[name] = frame
        self.built.add(name)
        return frame


def fixture_inputs(spark: SparkSession, root: str) -> FixtureInputs:
    return FixtureInputs(spark, root)


def catalog_inputs(spark: SparkSession, tables: dict[str, str]) -> Inputs:
    """Production inputs: each input name read from a catalog table.

    ``tables`` maps input names (the keys of ``BUILDERS``) to table names;
    reads are lazy, so only the inputs a job uses are touched.  The ledger
    that a job writes is not an input: it reads its own target.
    """
    out = Inputs({name: spark.table(table) for name, table in tables.items()})
    out.tables = dict(tables)
    return out
