"""Partner cost, channel cost, profit, deposit interest."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.rules import effective_rate

# fixed values: loan surcharge on the bill amount, bank and wallet channel
# names, annual deposit rate, days per year
LOAN_RATE = Decimal("0.00049")
BANK_CHANNEL = "channel_bank"
WALLET_CHANNEL = "channel_wallet"
LOAN = "loan"
DEPOSIT_RATE = Decimal("0.032")
DAYS_PER_YEAR = 365
# decimal types that keep cost arithmetic exact
AMOUNT = "decimal(18,2)"
RATE = "decimal(9,6)"
COST = "decimal(30,8)"



def _zero() -> Column:
    return F.lit(Decimal("0"))


def partner_cost(
    part_flag: Column,
    pay_channel: Column,
    loan_type: Column,
    bill_amount: Column,
    service_fee: Column,
    split_amount: Column,
    bill_date: Column,
    rate_old: Column,
    rate_new: Column,
    cut: date,
    float_rates: bool = False,
) -> Column:
    """P19.  flag '0': service fee x rate; flag '1' on the bank channel: split
    x rate; loans add bill x 0.049 %; anything else (and unknown product) 0.

    ``float_rates=True`` is the parity mode of Q9: rates are cast to 32-bit
    float as the modelled job does, and the result is a double."""
    if float_rates:
        rate = effective_rate(bill_date, cut, rate_old.cast("float"), rate_new.cast("float"))
        loan = loan_type == F.lit(LOAN)
        surcharge = bill_amount * F.lit(float(LOAN_RATE))

        def with_loan_f(base: Column) -> Column:
            return F.when(loan, surcharge + base * rate).otherwise(base * rate)

        return (F.when(part_flag == F.lit("0"), with_loan_f(service_fee))
                .when((part_flag == F.lit("1")) & (pay_channel == F.lit(BANK_CHANNEL)), with_loan_f(split_amount))
                .otherwise(F.lit(0.0))).cast("double")
    # Operands are bounded to DECIMAL(18,2) / DECIMAL(9,6) so every product
    # and sum stays exact (no precision-loss rounding above 38 digits).
    rate = effective_rate(bill_date, cut, rate_old.cast(RATE), rate_new.cast(RATE))
    loan = loan_type == F.lit(LOAN)
    surcharge = bill_amount.cast(AMOUNT) * F.lit(LOAN_RATE)
    service_fee, split_amount = service_fee.cast(AMOUNT), split_amount.cast(AMOUNT)

    def with_loan(base: Column) -> Column:
        return F.when(loan, surcharge + base * rate).otherwise(base * rate)

    return (
        F.when(part_flag == F.lit("0"), with_loan(service_fee))
        .when((part_flag == F.lit("1")) & (pay_channel == F.lit(BANK_CHANNEL)), with_loan(split_amount))
        .otherwise(_zero())
    ).cast(COST)


def channel_cost(channel_flag: Column, pay_channel: Column, split_amount: Column, channel_rate: Column,
                 float_rates: bool = False) -> Column:
    """Split x channel rate on the wallet channel when flagged, else 0.
    ``float_rates=True``: Q9 parity (rate as 32-bit float, double result)."""
    if float_rates:
        return F.when((channel_flag == F.lit("1")) & (pay_channel == F.lit(WALLET_CHANNEL)),
                      split_amount * channel_rate.cast("float")).otherwise(F.lit(0.0)).cast("double")
    return F.when(
        (channel_flag == F.lit("1")) & (pay_channel == F.lit(WALLET_CHANNEL)),
        split_amount.cast(AMOUNT) * channel_rate.cast(RATE),
    ).otherwise(_zero()).cast(COST)


def profit(service_fee: Column, late_fee: Column, cost_partner: Column, cost_channel: Column) -> Column:
    """Only a NULL late fee counts as 0; other NULLs propagate."""
    return service_fee + F.coalesce(late_fee, _zero()) - cost_partner - cost_channel


def deposit_interest(balance: Column) -> Column:
    """One day of interest on a deposit balance."""
    return balance * F.lit(DEPOSIT_RATE) / F.lit(DAYS_PER_YEAR)
