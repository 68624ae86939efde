"""Unit-cost job: bill cost detail (D12), deposit totals (D13), daily profit
(D14) and the daily detail extract (D15)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.context import RunContext
from ledgerline.functions.cost import (
    BANK_CHANNEL,
    COST,
    WALLET_CHANNEL,
    channel_cost,
    deposit_interest,
    partner_cost,
    profit,
)
from ledgerline.operators.joins import is_hot, restrict_to_keys, restrict_to_members
from ledgerline.sinks import create_bucketed

# fixed values: bill-line restriction (J1), partner-rate cut (P20)
BILL_FROM = "1998-01-01 00:00:00"
BILL_MONTH_FROM = "1998-01"  # month partitions of the bill lines
BILL_CARD_TYPE = "card_l"
RATE_CUT = date(1999, 1, 1)
# fixed values: deposit account rules (D13) and labels
CENTER_BANK_PREFIXES = ("BZ9", "9")
CENTER_BANK = "bank_a"
ONLINE_PREFIX = "5"
DEPOSIT_LABELS = ("center_bank_deposit", "center_online_deposit", "wallet_deposit")
PREPAID_CARD = "prepaid_card"


def bill_keys(bill_lines: DataFrame) -> DataFrame:
    c = F.col
    return bill_lines.where(
        (c("bill_time") >= F.lit(BILL_FROM).cast("timestamp_ntz")) & (c("card_type") == F.lit(BILL_CARD_TYPE))
        & (c("month") >= F.lit(BILL_MONTH_FROM))
    ).select("statement_id", "flow")


SALTS = 64


def spread_settlement(settlement: DataFrame) -> DataFrame:
    """Partial sums of the settlements of hot bills: a bill's rows are dealt by a salt of
    their content and summed per salt, so that no task holds all rows of one bill.  The
    sums per salt then stand for the rows."""
    salt = F.pmod(F.xxhash64(*settlement.columns), F.lit(SALTS))
    dealt = settlement.withColumn("__salt", salt).repartition("business_id", "__salt")
    sums = dealt.groupBy("business_id", "pay_channel", "__salt").agg(F.sum("split_amount").alias("split_amount"))
    return sums.drop("__salt")


def settlement_by_channel(settlement: DataFrame) -> DataFrame:
    """Split amount per (business id, channel) for the two cost channels."""
    return (settlement.where(F.col("pay_channel").isin(BANK_CHANNEL, WALLET_CHANNEL))
            .groupBy("business_id", "pay_channel").agg(F.sum("split_amount").alias("split_amount")))


def settlement_pivoted(settlement: DataFrame) -> DataFrame:
    """A7, one row per business id: the bank and wallet split sums side by
    side (conditional aggregation, one pass, no pivot value scan)."""
    c = F.col
    return (settlement.where(c("pay_channel").isin(BANK_CHANNEL, WALLET_CHANNEL))
            .groupBy("business_id")
            .agg(F.sum(F.when(c("pay_channel") == BANK_CHANNEL, c("split_amount"))).alias("split_bank"),
                 F.sum(F.when(c("pay_channel") == WALLET_CHANNEL, c("split_amount"))).alias("split_wallet")))


def bill_cost_detail(bill: DataFrame, bill_lines: DataFrame, settlement: DataFrame, product: DataFrame,
                     cut: date = RATE_CUT, pivot: bool = False, hot: list | None = None) -> DataFrame:
    """Bills restricted to the bill-line key set (semi join), left-joined
    to per-channel settlements (a bill paid through both channels yields two
    rows, Q8) and to the product cost dimension; partner and channel cost.
    Every column of the bills passes through.

    Bills are shuffled once, by statement, for both joins; from tables bucketed by
    statement (``store_by_statement``) not at all.  ``hot`` lists statements with so
    many bills that they are kept out of that: their bills are dealt by statement and
    flow, and the few settlement sums of at most ``1 / HOT_SHARE`` statements are
    broadcast.

    ``pivot=True`` (Q8 option): one row per bill with ``split_bank`` and
    ``split_wallet``; a flag-'0' partner cost is then counted once."""
    c = F.col
    if hot:
        parts = []
        for mine in (lambda key: ~is_hot(key, hot), lambda key: is_hot(key, hot)):
            parts.append((bill.where(mine(c("statement_id"))), bill_lines.where(mine(c("statement_id"))), settlement.where(mine(c("business_id")))))
        (cold, (b, lines, paid)) = parts
        b = restrict_to_keys(b.repartition("statement_id", "flow"), bill_keys(lines).repartition("statement_id", "flow"), ["statement_id", "flow"])
        paid = spread_settlement(paid)
        # one row a statement and channel, or one a statement: bounded by the number of hot statements
        paid = F.broadcast(settlement_pivoted(paid) if pivot else settlement_by_channel(paid))
        return bill_cost_detail(*cold, product, cut, pivot).unionByName(_priced(bill.columns, b, paid, product, cut, pivot))
    b = restrict_to_members(bill, bill_keys(bill_lines), "statement_id", "flow")
    return _priced(bill.columns, b, settlement_pivoted(settlement) if pivot else settlement_by_channel(settlement), product, cut, pivot)


def _priced(columns: list[str], b: DataFrame, s: DataFrame, product: DataFrame, cut: date, pivot: bool) -> DataFrame:
    """Restricted bills with their settlements, product and costs."""
    c = F.col
    if pivot:
        x = b.join(s, b["statement_id"] == s["business_id"], "left").drop("business_id")
        x = x.join(product, "product_id", "left")
        bank = F.when(c("split_bank").isNotNull(), F.lit(BANK_CHANNEL))
        wallet = F.when(c("split_wallet").isNotNull(), F.lit(WALLET_CHANNEL))
        return x.select(
            *columns, "split_bank", "split_wallet",
            partner_cost(c("part_flag"), bank, c("loan_type"), c("bill_amount"), c("service_fee"),
                         c("split_bank"), c("bill_date"), c("part_rate_old"), c("part_rate_new"), cut).alias("cost_partner"),
            channel_cost(c("channel_flag"), wallet, c("split_wallet"), c("channel_rate")).alias("cost_channel"),
        )
    x = b.join(s, b["statement_id"] == s["business_id"], "left").drop("business_id")
    x = x.join(product, "product_id", "left")
    return x.select(
        *columns, "pay_channel", "split_amount",
        partner_cost(c("part_flag"), c("pay_channel"), c("loan_type"), c("bill_amount"), c("service_fee"),
                     c("split_amount"), c("bill_date"), c("part_rate_old"), c("part_rate_new"), cut).alias("cost_partner"),
        channel_cost(c("channel_flag"), c("pay_channel"), c("split_amount"), c("channel_rate")).alias("cost_channel"),
    )


# A task of the joins sorts one bucket of each table: rows of the three tables in a bucket, together
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS, MOST_BUCKETS = 8, 100_000  # for parallel tasks; Spark's own limit


def statement_buckets(*tables: DataFrame) -> int:
    """Buckets for tables that are joined by bucket, by their counted rows: what a task
    holds stays the same as the tables grow, and there are more tasks."""
    rows = sum(t.count() for t in tables)
    return min(max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS)), MOST_BUCKETS)


def store_by_statement(bill: DataFrame, bill_lines: DataFrame, settlement: DataFrame, names: tuple[str, str, str],
                       buckets: int | None = None, paths: tuple | None = None) -> None:
    """Write the three large inputs of D12 bucketed by statement, so that its joins and
    sums need no shuffle (``bill_cost_detail`` on these tables).  Without ``buckets``
    their number follows the rows (``statement_buckets``)."""
    buckets = buckets or statement_buckets(bill, bill_lines, settlement)
    keys = ("statement_id", "statement_id", "business_id")
    for df, name, key, path in zip((bill, bill_lines, settlement), names, keys, paths or (None,) * 3, strict=True):
        create_bucketed(df, name, [key], buckets, path=path)


def deposit_totals(accounts: DataFrame, wallet: DataFrame, ctx: RunContext) -> DataFrame:
    """Three deposit totals for yesterday, one scan of the account table.

    The first total keeps the modelled precedence: prefix BZ9, or (prefix 9
    and the named bank).  A total over no rows is NULL.
    """
    c = F.col
    acc = c("accno")
    center = acc.startswith(CENTER_BANK_PREFIXES[0]) | (
        acc.startswith(CENTER_BANK_PREFIXES[1]) & (c("bank_name") == F.lit(CENTER_BANK)))
    online = acc.startswith(ONLINE_PREFIX)
    sums = accounts.agg(
        (F.sum(F.when(center, c("balance_cents"))) / 100).alias("a"),
        (F.sum(F.when(online, c("balance_cents"))) / 100).alias("b"),
    )
    accounts_rows = sums.select(F.inline(F.array(
        F.struct(c("a").alias("amount"), F.lit(DEPOSIT_LABELS[0]).alias("deposit_kind")),
        F.struct(c("b").alias("amount"), F.lit(DEPOSIT_LABELS[1]).alias("deposit_kind")),
    )))
    wallet_rows = wallet.agg(F.sum("wallet_balance").cast("double").alias("amount")) \
        .withColumn("deposit_kind", F.lit(DEPOSIT_LABELS[2]))
    day = ctx.yesterday.strftime("%Y%m%d")
    return accounts_rows.unionByName(wallet_rows).withColumn("bz_date", F.lit(day))


def daily_profit(cost_detail: DataFrame, deposits: DataFrame) -> DataFrame:
    """Per bill day and type: fees, costs, profit; plus one prepaid-card
    row per deposit day with a day of interest on the deposit balance."""
    c = F.col
    money = COST
    sums = ("service_fee", "late_fee", "cost_partner", "cost_channel")
    res = (cost_detail.groupBy(F.to_date("bill_date").alias("bz_date"), "big_bill_type")
           .agg(*[F.sum(n).cast(money).alias(n) for n in sums])
           .where(c("big_bill_type").isNotNull()))
    res = res.select(
        "bz_date", "big_bill_type", *sums,
        profit(c("service_fee"), c("late_fee"), c("cost_partner"), c("cost_channel")).cast(money).alias("profit"),
        F.lit(0).cast(money).alias("deposit_balance"),
    )
    dep = (deposits.groupBy(F.to_date("bz_date", "yyyyMMdd").alias("bz_date"))
           .agg(F.sum(c("amount").cast("decimal(28,2)")).alias("deposit_balance")))
    zero = F.lit(0).cast(money)
    dep = dep.select(
        "bz_date", F.lit(PREPAID_CARD).alias("big_bill_type"),
        zero.alias("service_fee"), zero.alias("late_fee"), zero.alias("cost_partner"), zero.alias("cost_channel"),
        F.round(deposit_interest(c("deposit_balance")), 6).cast(money).alias("profit"), c("deposit_balance").cast(money).alias("deposit_balance"),
    )
    return res.unionByName(dep)


def daily_extract(cost_detail: DataFrame, ctx: RunContext) -> DataFrame:
    """yesterday's cost lines with profit (compared as dates)."""
    c = F.col
    return cost_detail.where(F.to_date("bill_date") == F.lit(ctx.yesterday)).select(
        "bill_date", "flow", "big_bill_type", "bill_amount", "product_id", "service_fee", "late_fee",
        "cost_partner", "cost_channel",
        profit(c("service_fee"), c("late_fee"), c("cost_partner"), c("cost_channel")).alias("profit"),
        F.lit("0").alias("deposit_balance"), F.lit(ctx.yesterday.strftime("%Y%m%d")).alias("bz_date"),
    )
