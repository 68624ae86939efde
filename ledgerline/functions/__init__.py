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
from ledgerline.functions.geo import province
from ledgerline.functions.department import department
from ledgerline.functions.cost import channel_cost, deposit_interest, partner_cost, profit

__all__ = [
    "ordered_rule",
    "keep",
    "recode",
    "direction",
    "effective_rate",
    "not_in",
    "not_blank",
    "not_like",
    "net_price",
    "province",
    "department",
    "partner_cost",
    "channel_cost",
    "profit",
    "deposit_interest",
]
