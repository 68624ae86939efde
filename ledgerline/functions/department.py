"""Department attribution, first matching rule wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.functions.rules import ordered_rule

# fixed values: text in an open name that marks a smart device
SMART_NAME_TEXT = "smart_etc"
# fixed values: the same rules as rows of a decision table
DEPARTMENT_ROWS = [
    ("paid", 10, "segment", "=", L.BUS, L.DEPT_ETC), ("paid", 10, "scene", "<>", L.SIGNING, L.DEPT_ETC),
    ("live", 20, "segment", "=", L.BUS, L.DEPT_LIVE), ("live", 20, "in_channel", "is true", None, L.DEPT_LIVE),
    ("smart", 30, "segment", "=", L.BUS, L.DEPT_SMART), ("smart", 30, "open_name", "contains", SMART_NAME_TEXT, L.DEPT_SMART),
    ("bus", 40, "segment", "=", L.BUS, L.DEPT_ETC), ("truck", 50, "segment", "=", L.TRUCK, L.DEPT_DATA),
]


def department(segment: Column, scene: Column, in_channel: Column, open_name: Column) -> Column:
    """bus & scene != signing -> ETC; bus & sold through the channel -> live
    stream; bus & smart open name -> smart device; bus -> ETC; truck -> data;
    otherwise NULL.  A bus row with NULL scene skips the first rule."""
    bus = segment == F.lit(L.BUS)
    return ordered_rule(
        [
            (bus & (scene != F.lit(L.SIGNING)), L.DEPT_ETC),
            (bus & in_channel, L.DEPT_LIVE),
            (bus & open_name.like(f"%{SMART_NAME_TEXT}%"), L.DEPT_SMART),
            (bus, L.DEPT_ETC),
            (segment == F.lit(L.TRUCK), L.DEPT_DATA),
        ],
        None,
        has_default=False,
    )
