"""Rule columns: ordered CASE rules, recodes, null-aware predicates.

All of them return plain Catalyst expressions, so they stay inside
whole-stage code generation and need no join or UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def ordered_rule(rules: Sequence[tuple[Column, object]], default=None, *, has_default: bool = True) -> Column:
    """First matching rule wins: ``CASE WHEN c1 THEN v1 ... ELSE default END``.

    A rule whose condition is NULL does not match (SQL CASE semantics).
    ``has_default=False`` leaves the ELSE out, so unmatched rows are NULL.
    """
    out = None
    for cond, value in rules:
        out = F.when(cond, _lit(value)) if out is None else out.when(cond, _lit(value))
    if out is None:
        return _lit(default)
    return out.otherwise(_lit(default)) if has_default else out


def keep(rules: Sequence[tuple[Column, bool]], default: bool = True) -> Column:
    """CASE used as a predicate (F10): ordered include/exclude rules.

    ``CASE WHEN c1 THEN 1/0 ... ELSE 1 END = 1``; a NULL condition falls
    through to the next rule, so rows with NULL inputs are kept by default.
    """
    flag = ordered_rule([(c, 1 if v else 0) for c, v in rules], 1 if default else 0)
    return flag == F.lit(1)


def recode(col: Column, mapping: dict, default=None) -> Column:
    """Label recode (P13): ``CASE col WHEN k THEN v ... [ELSE default] END``."""
    return ordered_rule([(col == F.lit(k), v) for k, v in mapping.items()], default)


def direction(amount: Column, up: str, down: str) -> Column:
    """``up`` when > 0, ``down`` when < 0, NULL for 0 or NULL."""
    return F.when(amount > 0, F.lit(up)).when(amount < 0, F.lit(down))


def effective_rate(day: Column, cut: date, old: Column, new: Column) -> Column:
    """P20: the new rate from ``cut`` on (compared as dates), else the old one."""
    return F.when(F.to_date(day) >= F.lit(cut), new).otherwise(old)


def not_in(col: Column, values: Iterable, keep_null: bool = False) -> Column:
    """F6 / F7.  ``keep_null=False``: SQL NOT IN, NULL rows are dropped.
    ``keep_null=True``: ``nvl(col, sentinel) NOT IN (...)``, NULL rows kept."""
    values = list(values)
    if keep_null:
        return ~F.coalesce(col, F.lit("\u0000")).isin(values)
    return ~col.isin(values)


def not_like(col: Column, pattern: str, keep_null: bool = True) -> Column:
    """``nvl(col, '') NOT LIKE pattern`` (keeps NULL) or plain NOT LIKE."""
    if keep_null:
        return ~F.coalesce(col, F.lit("")).like(pattern)
    return ~col.like(pattern)


def not_blank(col: Column) -> Column:
    """F11 + F13: not NULL and not only spaces."""
    return col.isNotNull() & (F.trim(col) != F.lit(""))
