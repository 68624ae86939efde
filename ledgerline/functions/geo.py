"""Province from the first two characters of a device id."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import labels as L

# fixed values: two-digit device-id prefix -> province
PROVINCE_BY_PREFIX = {
    "44": "Guangdong",
    "45": "Guangxi",
    "13": "Hebei",
    "37": "Shandong",
    "15": "Inner Mongolia",
    "86": "Tianjin",
    "65": "Xinjiang",
    "53": "Yunnan",
    "40": "Guangdong",
    "20": "Guangdong",
    "19": "Guangdong",
    "36": "Jiangxi",
    "33": "Zhejiang",
    "51": "Sichuan",
    "22": "Guangdong",
}


def province(device_id: Column, table: dict | None = None, default: str = L.OTHER) -> Column:
    """Map lookup on the 2-character prefix; unknown or NULL ids -> default."""
    table = table or PROVINCE_BY_PREFIX
    lookup = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in table.items()))
    return F.coalesce(lookup[F.substring(device_id, 1, 2)], F.lit(default))
