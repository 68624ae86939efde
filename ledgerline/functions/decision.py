"""Ordered decision tables (P15, P17, F10): rules as data, compiled to one expression.

A rule has a priority, conditions ``(column, operator, value)`` that must all hold, and a
result.  Rules come as rows, one per condition, so they can be kept in a table; the
first rule by priority wins, and a condition that is NULL does not hold, as in a CASE.
The table is a few rows: it is compiled on the driver into one CASE expression, inside
code generation, with no join.

``unreachable`` reports rules that an earlier rule always takes first, ``asymmetric``
rules for an amount without their mirror image for the opposite amount.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.rules import keep, ordered_rule

ROW_SCHEMA = "rule string, priority int, column string, operator string, value string, result string"

OPERATORS = {
    "=": lambda c, v: c == F.lit(v),
    "<>": lambda c, v: c != F.lit(v),
    "<": lambda c, v: c < F.lit(v),
    "<=": lambda c, v: c <= F.lit(v),
    ">": lambda c, v: c > F.lit(v),
    ">=": lambda c, v: c >= F.lit(v),
    "contains": lambda c, v: c.contains(v),
    "starts with": lambda c, v: c.startswith(v),
    "is null": lambda c, v: c.isNull(),
    "is not null": lambda c, v: c.isNotNull(),
    "is true": lambda c, v: c,
}


@dataclass(frozen=True)
class Rule:
    name: str
    priority: int
    conditions: tuple[tuple[str, str, str | None], ...]
    result: str | None


def rules_of(rows: DataFrame | Iterable) -> list[Rule]:
    """Rules from rows of ``ROW_SCHEMA``: one row per condition; a rule without
    conditions has one row with a null column.  Unknown operators, two results for one
    rule and equal priorities raise."""
    found: dict[str, Rule] = {}
    for r in rows.collect() if isinstance(rows, DataFrame) else rows:
        name, priority, column, operator, value, result = r
        if column is not None and operator not in OPERATORS:
            raise ValueError(f"rule {name!r}: unknown operator {operator!r}")
        own = ((column, operator, value),) if column is not None else ()
        old = found.get(name)
        if old and (old.priority, old.result) != (priority, result):
            raise ValueError(f"rule {name!r} has two priorities or results")
        found[name] = Rule(name, priority, (old.conditions if old else ()) + own, result)
    out = sorted(found.values(), key=lambda r: r.priority)
    if len({r.priority for r in out}) < len(out):
        raise ValueError("two rules have one priority")
    return out


def condition(rule: Rule, columns: dict[str, Column]) -> Column:
    out = F.lit(True)
    for name, operator, value in rule.conditions:
        out = out & OPERATORS[operator](columns[name], value)
    return out


def decide(rules: list[Rule], columns: dict[str, Column], default: str | None = None) -> Column:
    """The result of the first rule whose conditions hold."""
    return ordered_rule([(condition(r, columns), r.result) for r in rules], default)


def keeps(rules: list[Rule], columns: dict[str, Column]) -> Column:
    """whether a row is kept by rules with the results ``keep`` and ``drop``."""
    return keep([(condition(r, columns), r.result == "keep") for r in rules])


def _implies(a: tuple, b: tuple) -> bool:
    """Whether condition ``a`` holding means that ``b`` holds."""
    if a == b:
        return True
    (column, op, value), (other, wanted, limit) = a, b
    if column != other or op in ("is null", "is true"):
        return False
    if wanted == "is not null":
        return True
    if op != "=":
        return False
    if wanted == "<>":
        return value != limit
    if wanted == "contains":
        return limit in value
    if wanted == "starts with":
        return value.startswith(limit)
    return False


def unreachable(rules: list[Rule]) -> list[tuple[str, str]]:
    """``(rule, earlier rule)``: every row of the rule is taken by the earlier one."""
    out = []
    for i, rule in enumerate(rules):
        for earlier in rules[:i]:
            if all(any(_implies(mine, theirs) for mine in rule.conditions) for theirs in earlier.conditions):
                out.append((rule.name, earlier.name))
                break
    return out


def asymmetric(rules: list[Rule], column: str) -> list[str]:
    """Rules for an amount whose mirror (the opposite amount, else equal conditions) is
    missing or does not give the opposite result."""
    def key(rule: Rule, sign: int):
        amount = [Decimal(v) * sign for c, op, v in rule.conditions if c == column and op == "="]
        rest = frozenset(x for x in rule.conditions if x[0] != column or x[1] != "=")
        return (amount[0], rest) if amount and rule.result is not None else None

    by_key = {key(r, 1): r for r in rules if key(r, 1)}
    out = []
    for k, rule in by_key.items():
        mirror = by_key.get(key(rule, -1))
        if mirror is None or Decimal(mirror.result) != -Decimal(rule.result):
            out.append(rule.name)
    return out
