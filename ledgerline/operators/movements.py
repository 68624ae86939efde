"""One-scan movement expansion.

Several movement arms (receivable / received x collect / refund) read the
same snapshot with different predicates.  Instead of one scan and one
shuffle per arm, every source row emits the arms it satisfies through
``array_compact(array(when(pred_i, struct_i)...))`` + ``inline``: one scan,
no per-arm shuffle, then one deduplication.  Arms carry different constant
tags, so one global distinct equals the per-arm distincts.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class MovementSpec:
    name: str
    where: Column
    values: dict  # output column -> Column or literal (same keys for every arm)
    extra: dict = field(default_factory=dict)


def _col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def expand_movements(df: DataFrame, arms: list[MovementSpec], columns: list[str],
                     types: dict[str, str] | None = None, distinct: bool = True) -> DataFrame:
    """Emit one row per (source row, satisfied arm), projected to ``columns``.

    ``types`` casts every arm's value to one type per column, so the struct
    types agree across arms.  Deduplication happens on the raw values (before
    any later cast), as the per-arm GROUP BY it replaces did.
    """
    types = types or {}

    def typed(name, v):
        c = _col(v)
        return c.cast(types[name]) if name in types else c

    structs = [
        F.when(arm.where, F.struct(*[typed(c, arm.values[c]).alias(c) for c in columns]))
        for arm in arms
    ]
    rows = df.select(F.inline(F.array_compact(F.array(*structs))))
    return rows.distinct() if distinct else rows
