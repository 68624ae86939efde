"""Service movements (one-scan arms) and monthly debit/refund totals.

The oracles state the movement rules as small tables of rules joined to one
base, with their own literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans import services as S
from ledgerline.plans.inputs import fixture_inputs
from ledgerline.registry.base import MONTH_CLOSE, register
from ledgerline.schema import for_compare
from ledgerline.sources import fixtures as fx


_OTHER_FX = ["fx_detail", "fx_other_adjustments"]
# a rule: which service type moves which amount, when, and with which sign
_OTHER_CTES = """rule(scene, kind, sign) AS (
  VALUES ('receivable', 'collect', 1), ('receivable_decrease', 'refund', -1), ('received', 'collect', 1), ('received_decrease', 'refund', -1)
), served AS (
  SELECT * FROM fx_detail
  WHERE stock_type IS NULL AND NOT list_contains(['new', 'replace', 'cancel', 'rebind_refund'], service_scene2)
    AND (openname IS NULL OR NOT list_contains(['excluded_channel', 'excluded_bank_wechat', 'excluded_bank_app'], openname))
), timed AS (
  SELECT served.*, scene, sign, CASE scene WHEN 'receivable' THEN obu_should_time WHEN 'receivable_decrease' THEN should_refund_time
                                ELSE CAST(CAST(actual_time AS DATE) AS TIMESTAMP) END AS moment,
         CASE WHEN starts_with(scene, 'received') THEN actual_amount ELSE nullif(should_amount, 0) END AS amount
  FROM served JOIN rule ON kind = service_type
), movement AS (
  SELECT DISTINCT sale_department, service_scene2, moment, obu_id, CAST(sign * amount AS DECIMAL(18,2)) AS price, id, ds, scene
  FROM timed WHERE moment IS NOT NULL AND (amount IS NOT NULL OR starts_with(scene, 'received'))
), listed AS (
  SELECT sale_department, service_scene2, CAST(moment AS DATE) AS date, obu_id, CAST(price AS DOUBLE) AS price, id, ds, scene,
         'normal' AS data_type, strftime(moment, '%Y-%m') AS month
  FROM movement WHERE length(trim(obu_id)) > 0
), corrected AS (
  SELECT sale_department, service_scene2, CAST(date AS DATE) AS date, obu_id, CAST(price AS DOUBLE) AS price, id, ds, scene, data_type, month
  FROM fx_other_adjustments WHERE length(trim(obu_id)) > 0
)"""
_OTHER_TODAY = ("SELECT * FROM listed WHERE ds = '20010801' AND month >= '2001-07' "
                "UNION ALL SELECT * FROM corrected WHERE date >= DATE '2001-07-01'")
# each month from the snapshot of the 1st after it; today's also holds what lies ahead
_OTHER_REBUILT = """SELECT * FROM listed
WHERE (ds, month) IN (('20010601', '2001-05'), ('20010701', '2001-06'), ('20010801', '2001-07'), ('20010801', '2001-08'))
   OR (ds = '20010801' AND month > '2001-08')
UNION ALL SELECT * FROM corrected WHERE month >= '2001-05'"""


def _other(spark: SparkSession, root: str, mode: str = "incremental") -> DataFrame:
    i = fixture_inputs(spark, root)
    return S.other_movements(i["service_detail"], MONTH_CLOSE, adjustments=i["other_adjustments"], mode=mode)


@register("movements_other", fx.with_fixtures(_OTHER_TODAY, _OTHER_FX, _OTHER_CTES))
def movements_other(spark: SparkSession, root: str) -> DataFrame:
    """Four movement arms from one scan, deduplicated, and
    the hand-loaded corrections."""
    return for_compare(_other(spark, root))


@register("movements_other_rebuild", fx.with_fixtures(_OTHER_REBUILT, _OTHER_FX, _OTHER_CTES))
def movements_other_rebuild(spark: SparkSession, root: str) -> DataFrame:
    """All closed months, each from the snapshot that closed it."""
    return for_compare(_other(spark, root, mode="rebuild"))


@register("movements_other_summary", fx.with_fixtures(
    "SELECT data_type, sale_department, service_scene2, scene, date, price, count(obu_id) AS obu_amt, "
    f"sum(price) AS money FROM ({_OTHER_TODAY}) m GROUP BY ALL", _OTHER_FX, _OTHER_CTES))
def movements_other_summary(spark: SparkSession, root: str) -> DataFrame:
    """A3 over D9."""
    return for_compare(S.other_summary(_other(spark, root)))


# a rule: scene column and value, service type, how the movement is named, and what dates, keys and prices it
_AFTER_CTES = """rule(data_type, scene, adjust_type, kind, first_scene, second_scene, dated_by, keyed_by, priced_by, sign) AS (
  VALUES ('receivable', 'after_sales_paid', 'receivable', 'collect', 'replace', NULL, 'device', 'device', 'due', 1),
         ('received', 'after_sales_paid', 'received', 'collect', 'replace', NULL, 'paid', 'device', 'paid', 1),
         ('receivable', 'cancel_paid', 'receivable', 'collect', 'cancel', NULL, 'any', 'any', 'due or 0', 1),
         ('received', 'cancel_paid', 'received', 'collect', 'cancel', NULL, 'paid', 'any', 'paid', 1),
         ('receivable', 'after_sales_paid', 'decrease', 'refund', NULL, 'replace', 'refund', 'device', 'due', -1),
         ('receivable', 'cancel_paid', 'decrease', 'refund', NULL, 'cancel', 'refund', 'any', 'due', -1),
         ('received', 'after_sales_paid', 'decrease', 'refund', NULL, 'replace', 'paid', 'device', 'paid', -1),
         ('received', 'cancel_paid', 'decrease', 'refund', NULL, 'cancel', 'paid', 'device', 'paid', -1)
), timed AS (
  SELECT r.data_type, r.scene, r.adjust_type, r.priced_by, d.sale_department, d.id, d.ds,
         CASE dated_by WHEN 'device' THEN date_trunc('day', obu_should_time) WHEN 'paid' THEN date_trunc('day', actual_time)
                       WHEN 'any' THEN date_trunc('day', coalesce(obu_should_time, card_should_time)) ELSE should_refund_time END AS moment,
         CASE keyed_by WHEN 'any' THEN coalesce(obu_id, id) ELSE obu_id END AS obu_id,
         CASE priced_by WHEN 'paid' THEN actual_amount WHEN 'due' THEN nullif(should_amount, 0) ELSE coalesce(should_amount, 0) END * sign AS amount
  FROM fx_detail d JOIN rule r ON d.service_type = r.kind
       AND (r.first_scene IS NULL OR d.service_scene = r.first_scene) AND (r.second_scene IS NULL OR d.service_scene2 = r.second_scene)
  WHERE d.sale_department <> 'etc'
), movement AS (
  SELECT DISTINCT data_type, scene, adjust_type, sale_department, moment, obu_id, CAST(amount AS DECIMAL(18,2)) AS price, id, ds
  FROM timed WHERE moment IS NOT NULL AND (amount IS NOT NULL OR priced_by = 'paid')
), listed AS (
  SELECT data_type, scene, adjust_type, sale_department, CAST(moment AS DATE) AS date, obu_id, CAST(price AS DOUBLE) AS price, id, ds,
         strftime(moment, '%Y-%m') AS month FROM movement
)"""
_AFTER_TODAY = "SELECT * FROM listed WHERE ds = '20010801' AND month >= '2001-07'"


@register("movements_aftersales", fx.with_fixtures(_AFTER_TODAY, ["fx_detail"], _AFTER_CTES))
def movements_aftersales(spark: SparkSession, root: str) -> DataFrame:
    """D11, P10, P28 fixed: eight after-sales/cancellation arms, one scan."""
    return for_compare(S.aftersales_movements(fx.fx_detail(spark, root), MONTH_CLOSE))


@register("movements_aftersales_rebuild", fx.with_fixtures("""SELECT * FROM listed
WHERE (ds, month) IN (('20010701', '2001-06'))""", ["fx_detail"], _AFTER_CTES))
def movements_aftersales_rebuild(spark: SparkSession, root: str) -> DataFrame:
    """One missed month re-closed from its snapshot."""
    return for_compare(S.aftersales_movements(fx.fx_detail(spark, root), MONTH_CLOSE, mode="rebuild", months=["2001-06"]))


@register("movements_aftersales_summary", fx.with_fixtures(
    "SELECT data_type, scene, adjust_type, sale_department, date, price, count(obu_id) AS obu_amt, "
    f"sum(price) AS money FROM ({_AFTER_TODAY}) m GROUP BY ALL", ["fx_detail"], _AFTER_CTES))
def movements_aftersales_summary(spark: SparkSession, root: str) -> DataFrame:
    """A3 over D11."""
    return for_compare(S.aftersales_summary(S.aftersales_movements(fx.fx_detail(spark, root), MONTH_CLOSE)))


@register("monthly_debit_refund", fx.with_fixtures("""
SELECT strftime(day, '%Y-%m') AS month, type, CAST(sum(equipment_amount) AS DOUBLE) AS money
FROM (SELECT equipment_amount, unnest([{'type': 'debit', 'day': CAST(gmt_payment AS DATE)}, {'type': 'refund', 'day': CAST(gmt_refund AS DATE)}], recursive := true)
      FROM fx_equipment WHERE pay_state = 'SUCCESS' AND department = 'etc')
WHERE day >= DATE '2000-03-01' GROUP BY ALL""", ["fx_equipment"]))
def monthly_debit_refund(spark: SparkSession, root: str) -> DataFrame:
    """Monthly debit and refund totals, one scan + one aggregate."""
    return for_compare(S.debit_refund_totals(fx.fx_equipment(spark, root)))
