"""Unit-cost job: bill cost detail, key-set restriction, deposits, daily profit, daily extract."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.context import RunContext
from ledgerline.operators.joins import few_rows, hot_keys, restrict_to_keys
from ledgerline.operators.lookup import rate_from_table
from ledgerline.plans import cost as C
from ledgerline.plans.inputs import fixture_inputs
from ledgerline.registry.base import register
from ledgerline.schema import for_compare
from ledgerline.session import scratch_path
from ledgerline.sources import fixtures as fx


# fixed values: cost-job run day (its "yesterday" is 1998-03-01)
COST_DAY = RunContext(as_of=date(1998, 3, 2))
RATE_EPOCH = date(1900, 1, 1)  # first day of the oldest rate version
# bills of the wanted lines, the rate of their day, what each channel settled, and the amount that the partner's share is of
_PRICED_CTES = """wanted AS (
  SELECT b.*, p.part_flag, p.channel_flag, p.channel_rate, if(b.bill_date < DATE '1999-01-01', p.part_rate_old, p.part_rate_new) AS part_rate,
         if(b.loan_type = 'loan', b.bill_amount * 0.00049, 0) AS surcharge
  FROM fx_bill b LEFT JOIN fx_product p USING (product_id)
  WHERE EXISTS (SELECT 1 FROM fx_bill_lines l WHERE l.statement_id = b.statement_id AND l.flow = b.flow AND l.card_type = 'card_l'
                AND l.bill_time >= TIMESTAMP '1998-01-01' AND l.month >= '1998-01')
), settled AS (
  SELECT business_id AS statement_id, pay_channel, sum(split_amount) AS split_amount
  FROM fx_settlement WHERE pay_channel <> 'channel_other' GROUP BY ALL
)"""
_DETAIL = ("statement_id, flow, bill_date, product_id, loan_type, big_bill_type, CAST(bill_amount AS DOUBLE) AS bill_amount, "
           "CAST(service_fee AS DOUBLE) AS service_fee, CAST(late_fee AS DOUBLE) AS late_fee, user_id, state, account_id, period_id, flow_level, "
           "CAST(last_due_date AS TIMESTAMP) AS last_due_date, CAST(cleared_date AS TIMESTAMP) AS cleared_date, repayment_id, bill_type, big_type, "
           "CAST(total_amount AS DOUBLE) AS total_amount, CAST(repayment AS DOUBLE) AS repayment, CAST(actual_amount AS DOUBLE) AS actual_amount, "
           "customer_id, CAST(open_date AS TIMESTAMP) AS open_date, is_white, cust_state")
_COST_CTE = _PRICED_CTES + """, shared AS (
  SELECT *, CASE part_flag WHEN '0' THEN service_fee WHEN '1' THEN if(pay_channel = 'channel_bank', split_amount, NULL) END AS share,
         if(channel_flag = '1' AND pay_channel = 'channel_wallet', split_amount * channel_rate, 0) AS channel_share
  FROM wanted LEFT JOIN settled USING (statement_id)
), cost AS (
  SELECT *, CAST(coalesce(share * part_rate + surcharge, 0) AS DECIMAL(30,8)) AS cost_partner,
         CAST(channel_share AS DECIMAL(30,8)) AS cost_channel FROM shared
)"""
_COST_FX = ["fx_bill", "fx_bill_lines", "fx_settlement", "fx_product"]
_DEPOSIT_BODY = """
SELECT unnest(['center_bank_deposit', 'center_online_deposit', 'wallet_deposit']) AS deposit_kind, unnest([center, online, wallet]) AS amount,
       '19980301' AS bz_date
FROM (SELECT sum(balance_cents) FILTER (starts_with(accno, 'BZ9') OR bank_name = 'bank_a' AND starts_with(accno, '9')) / 100 AS center,
             sum(balance_cents) FILTER (starts_with(accno, '5')) / 100 AS online FROM fx_accounts),
     (SELECT CAST(sum(wallet_balance) AS DOUBLE) AS wallet FROM fx_wallet)"""


def _cost_detail(spark: SparkSession, root: str) -> DataFrame:
    i = fixture_inputs(spark, root)
    return C.bill_cost_detail(i["bill"], i["bill_lines"], i["settlement"], i["product"])


ORACLE_DETAIL = fx.with_fixtures(
    f"SELECT {_DETAIL}, pay_channel, CAST(split_amount AS DOUBLE) AS split_amount, CAST(cost_partner AS DOUBLE) AS cost_partner, "
    "CAST(cost_channel AS DOUBLE) AS cost_channel FROM cost", _COST_FX, _COST_CTE)


@register("cost_bill_detail", ORACLE_DETAIL)
def cost_bill_detail(spark: SparkSession, root: str) -> DataFrame:
    """Bill cost detail."""
    return for_compare(_cost_detail(spark, root))


@register("cost_detail_colocated", ORACLE_DETAIL)
def cost_detail_colocated(spark: SparkSession, root: str) -> DataFrame:
    """D12, J1, J2, J3 over tables bucketed by statement: no shuffle of the bills; the
    most frequent statements taken apart."""
    i = fixture_inputs(spark, root)
    names = tuple(f"{n}_{uuid.uuid4().hex[:8]}" for n in ("bills", "bill_lines", "settlements"))
    C.store_by_statement(i["bill"], i["bill_lines"], i["settlement"], names, paths=tuple(scratch_path(spark, n) for n in names))
    bill, lines, paid = (spark.table(n) for n in names)
    hot = hot_keys(bill, "statement_id")
    return for_compare(C.bill_cost_detail(bill, lines, paid, few_rows(i["product"]), hot=hot))


@register("cost_semi_only", """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F' AND l_shipdate >= TIMESTAMP '1998-01-01')""")
def cost_semi_only(spark: SparkSession, root: str) -> DataFrame:
    """Grouped-key INNER JOIN rewritten as LEFT SEMI (count unused)."""
    li = fx.load_table(spark, root, "lineitem")
    o = fx.load_table(spark, root, "orders")
    keys = li.where((F.col("l_shipdate") >= F.lit("1998-01-01 00:00:00").cast("timestamp_ntz"))
                    & (F.col("l_linestatus") == "F"))
    return restrict_to_keys(o, keys, ["o_orderkey"], ["l_orderkey"]).select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@register("deposit_totals", fx.with_fixtures(_DEPOSIT_BODY, ["fx_accounts", "fx_wallet"]))
def deposit_totals(spark: SparkSession, root: str) -> DataFrame:
    """Three deposit totals (one scan of the accounts)."""
    i = fixture_inputs(spark, root)
    return C.deposit_totals(i["accounts"], i["wallet"], COST_DAY)


_PROFIT_SQL = f"""
SELECT bill_date AS bz_date, big_bill_type, CAST(sum(service_fee) AS DOUBLE) AS service_fee, CAST(sum(late_fee) AS DOUBLE) AS late_fee,
       CAST(sum(cost_partner) AS DOUBLE) AS cost_partner, CAST(sum(cost_channel) AS DOUBLE) AS cost_channel,
       CAST(sum(service_fee) + coalesce(sum(late_fee), 0) - sum(cost_partner) - sum(cost_channel) AS DOUBLE) AS profit, 0.0::DOUBLE AS deposit_balance
FROM cost WHERE big_bill_type IS NOT NULL GROUP BY ALL
UNION ALL
SELECT DATE '1998-03-01', 'prepaid_card', 0, 0, 0, 0, round(total * 0.032 / 365, 6)::DOUBLE, total::DOUBLE
FROM (SELECT sum(amount::DECIMAL(28,2)) AS total FROM ({_DEPOSIT_BODY}))"""


@register("daily_profit", fx.with_fixtures(_PROFIT_SQL, _COST_FX + ["fx_accounts", "fx_wallet"], _COST_CTE))
def daily_profit(spark: SparkSession, root: str) -> DataFrame:
    """Daily profit plus deposit interest."""
    i = fixture_inputs(spark, root)
    return for_compare(C.daily_profit(_cost_detail(spark, root), C.deposit_totals(i["accounts"], i["wallet"], COST_DAY)))


_EXTRACT_SQL = """
SELECT bill_date, flow, big_bill_type, CAST(bill_amount AS DOUBLE) AS bill_amount, product_id,
       CAST(service_fee AS DOUBLE) AS service_fee, CAST(late_fee AS DOUBLE) AS late_fee, CAST(cost_partner AS DOUBLE) AS cost_partner,
       CAST(cost_channel AS DOUBLE) AS cost_channel,
       CAST(service_fee - (cost_partner + cost_channel) + coalesce(late_fee, 0) AS DOUBLE) AS profit,
       '0' AS deposit_balance, '19980301' AS bz_date
FROM cost WHERE bill_date = DATE '1998-03-01'"""


@register("cost_daily_extract", fx.with_fixtures(_EXTRACT_SQL, _COST_FX, _COST_CTE))
def cost_daily_extract(spark: SparkSession, root: str) -> DataFrame:
    """D15, F18 (fixed: compared as dates): yesterday's cost lines + profit."""
    return for_compare(C.daily_extract(_cost_detail(spark, root), COST_DAY))


@register("cost_rate_table", fx.with_fixtures("""
SELECT statement_id, flow, bill_date, product_id, CAST(if(bill_date < DATE '1999-01-01', part_rate_old, part_rate_new) AS DOUBLE) AS part_rate
FROM fx_bill LEFT JOIN fx_product USING (product_id)""", ["fx_bill", "fx_product"]))
def cost_rate_table(spark: SparkSession, root: str) -> DataFrame:
    """P20, general form: the partner rate of every bill looked up in a
    rate-version table (old rate until the cut day, new from it)."""
    i = fixture_inputs(spark, root)
    p = i["product"]
    old = p.select(F.col("product_id").alias("key"), F.lit(RATE_EPOCH).alias("valid_from"),
                   F.lit(C.RATE_CUT).alias("valid_to"), F.col("part_rate_old").alias("rate"))
    new = p.select(F.col("product_id").alias("key"), F.lit(C.RATE_CUT).alias("valid_from"),
                   F.lit(None).cast("date").alias("valid_to"), F.col("part_rate_new").alias("rate"))
    bills = i["bill"].select("statement_id", "flow", "bill_date", "product_id")
    return rate_from_table(bills, old.unionByName(new), "product_id", "bill_date", "part_rate")


@register("cost_bill_detail_pivot", fx.with_fixtures(f"""
SELECT {_DETAIL}, CAST(bank AS DOUBLE) AS split_bank, CAST(wallet AS DOUBLE) AS split_wallet,
       CAST(CAST(coalesce(CASE part_flag WHEN '0' THEN service_fee WHEN '1' THEN bank END * part_rate + surcharge, 0) AS DECIMAL(30,8)) AS DOUBLE) AS cost_partner,
       CAST(CAST(coalesce(if(channel_flag = '1', wallet, NULL) * channel_rate, 0) AS DECIMAL(30,8)) AS DOUBLE) AS cost_channel
FROM wanted LEFT JOIN sides USING (statement_id)""", _COST_FX, _PRICED_CTES + """, sides AS (
  SELECT statement_id, max(split_amount) FILTER (pay_channel = 'channel_bank') AS bank, max(split_amount) FILTER (pay_channel = 'channel_wallet') AS wallet
  FROM settled GROUP BY ALL
)"""))
def cost_bill_detail_pivot(spark: SparkSession, root: str) -> DataFrame:
    """D12 with the Q8 option: settlements pivoted per bill (conditional
    aggregation), one row per bill, flag-'0' partner cost counted once."""
    i = fixture_inputs(spark, root)
    return C.bill_cost_detail(i["bill"], i["bill_lines"], i["settlement"], i["product"], pivot=True)
