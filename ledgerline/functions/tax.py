"""After-tax value of a bus ledger line (goods at 13 %, service at 6 %).

The rule table is data; the generated CASE evaluates it in codegen without a
join.  Each part is rounded to 6 decimals, the result is DECIMAL(18,6).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import labels as L

# fixed values: goods VAT divisor, service VAT divisor, prepaid service amount
GOODS_VAT = Decimal("1.13")
SERVICE_VAT = Decimal("1.06")
PREPAID_SERVICE = Decimal("73")

# fixed values: (scene, price) -> (goods part, service part); first match wins.
# The -195 tier uses service part 116 while +195 uses 101 (kept as found).
TAX_TIERS = [
    (L.SIGNING, 80, 50, 30),
    (L.SIGNING, -80, -50, -30),
    (L.SIGNING, 70, 50, 20),
    (L.SIGNING, -70, -50, -20),
    (L.SIGNING, 150, 94, 56),
    (L.SIGNING, -150, -94, -56),
    (L.SIGNING, 130, 94, 36),
    (L.SIGNING, -130, -94, -36),
    (L.SIGNING, 180, 94, 86),
    (L.SIGNING, -180, -94, -86),
    (L.SIGNING, 195, 94, 101),
    (L.SIGNING, -195, -94, -116),
    (L.SIGNING, 210, 94, 116),
    (L.SIGNING, -210, -94, -116),
    (L.NEW_PAID, 180, 94, 86),
    (L.NEW_PAID, -180, -94, -86),
]

OUT = "decimal(18,6)"


def _part(amount, divisor: Decimal) -> Column:
    a = amount if isinstance(amount, Column) else F.lit(Decimal(amount))
    return F.round(a / F.lit(divisor), 6)


def asymmetric_tiers() -> list[tuple[str, int]]:
    """Lint: tiers whose negative twin has different parts (Q1)."""
    parts = {(s, p): (g, v) for s, p, g, v in TAX_TIERS}
    out = []
    for (s, p), (g, v) in parts.items():
        twin = parts.get((s, -p))
        if p > 0 and twin is not None and twin != (-g, -v):
            out.append((s, p))
    return out


def net_price(segment: Column, scene: Column, price: Column) -> Column:
    """After-tax price; 0 for trucks and for anything no tier covers."""
    bus = segment == F.lit(L.BUS)
    rules = []
    for s, p, goods, service in TAX_TIERS:
        value = (_part(goods, GOODS_VAT) + _part(service, SERVICE_VAT)).cast(OUT)
        rules.append((bus & (scene == F.lit(s)) & (price == F.lit(p)), value))
    rules.append((bus & (scene == F.lit(L.NEW_PAID)) & (price != F.lit(180)), _part(price.cast("decimal(18,2)"), SERVICE_VAT).cast(OUT)))
    rules.append((bus & (scene == F.lit(L.PREPAID)), _part(PREPAID_SERVICE, SERVICE_VAT).cast(OUT)))
    out = None
    for cond, value in rules:
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise(F.lit(Decimal(0)).cast(OUT))
