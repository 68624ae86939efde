"""Each fixture view: the Spark builder and its SQL twin give the same rows
(sf0.001), so an oracle mismatch can be told apart from a fixture mismatch."""

import pytest

from compare import compare
from ledgerline.plans.inputs import BUILDERS
from ledgerline.sources import fixtures as fx

SMALL = "/root/testdata/sf0.001"
TWINS = {
    "fx_snapshot": (fx.fx_snapshot, fx.FX_SNAPSHOT_SQL),
    "fx_ledger": (fx.fx_ledger, fx.FX_LEDGER_SQL),
    "fx_detail": (fx.fx_detail, fx.FX_DETAIL_SQL),
    "fx_equipment": (fx.fx_equipment, fx.FX_EQUIPMENT_SQL),
    "fx_bill": (fx.fx_bill, fx.FX_BILL_SQL),
    "fx_settlement": (fx.fx_settlement, fx.FX_SETTLEMENT_SQL),
    "fx_product": (fx.fx_product, fx.FX_PRODUCT_SQL),
    "fx_bill_lines": (fx.fx_bill_lines, fx.FX_BILL_LINES_SQL),
    "fx_accounts": (fx.fx_accounts, fx.FX_ACCOUNTS_SQL),
    "fx_wallet": (fx.fx_wallet, fx.FX_WALLET_SQL),
    "fx_external_channel": (fx.fx_external_channel, fx.FX_EXTERNAL_CHANNEL_SQL),
    "fx_shop_orders": (fx.fx_shop_orders, fx.FX_SHOP_ORDERS_SQL),
    "fx_shop_serials": (fx.fx_shop_serials, fx.FX_SHOP_SERIALS_SQL),
    "fx_shop_items": (fx.fx_shop_items, fx.FX_SHOP_ITEMS_SQL),
    "fx_device": (fx.fx_device, fx.FX_DEVICE_SQL),
    "fx_order_map": (fx.fx_order_map, fx.FX_ORDER_MAP_SQL),
    "fx_person_scenes": (fx.fx_person_scenes, fx.FX_PERSON_SCENES_SQL),
    "fx_loaded_corrections": (fx.fx_loaded_corrections, fx.FX_LOADED_CORRECTIONS_SQL),
    "fx_after_sales": (fx.fx_after_sales, fx.FX_AFTER_SALES_SQL),
    "fx_live_adjustments": (fx.fx_live_adjustments, fx.FX_LIVE_ADJUSTMENTS_SQL),
    "fx_person_services": (fx.fx_person_services, fx.FX_PERSON_SERVICES_SQL),
    "fx_manual_income": (fx.fx_manual_income, fx.FX_MANUAL_INCOME_SQL),
    "fx_other_adjustments": (fx.fx_other_adjustments, fx.FX_OTHER_ADJUSTMENTS_SQL),
    "fx_corrections": (fx.fx_corrections, None),
    "fx_adjust_file": (fx.fx_adjust_file, None),
}


@pytest.fixture(scope="module")
def tiny_duck():
    from compare import duck

    return duck(SMALL)


def test_every_input_builder_has_a_twin():
    # the merged ledger is fx_ledger with its net price, which ledger_tax_split compares
    assert {b.__name__ for b in BUILDERS.values()} - {"fixture_merged_ledger"} <= set(TWINS)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_fixture_matches_its_sql_twin(spark, tiny_duck, name):
    builder, sql = TWINS[name]
    deps = [] if sql is not None else ["fx_ledger"]
    body = f"SELECT * FROM {name}"
    text = fx.with_fixtures(body, deps + [name]) if sql is None else f"WITH {name} AS ({sql}) {body}"
    problems, rows = compare(builder(spark, SMALL), tiny_duck, text)
    assert not problems, problems
    assert rows > 0
