"""Aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def summarise(df: DataFrame, keys: list, count_col: str, sum_col: str,
              count_name: str = "obu_amt", sum_name: str = "money") -> DataFrame:
    """A3: ``count(count_col)`` (skips NULLs) and ``sum(sum_col)`` per keys.

    Partial aggregation runs before the shuffle, so a hot key costs one row
    per map task, not one row per input row.
    """
    return df.groupBy(*keys).agg(F.count(count_col).alias(count_name), F.sum(sum_col).alias(sum_name))


def monthly_flows(df: DataFrame, flows: list[tuple], amount: Column,
                  month_name: str = "month", type_name: str = "type", sum_name: str = "money") -> DataFrame:
    """A5: several (label, predicate, event column[, amount]) flows summed per
    month.  One scan: each row emits the flows it belongs to, then one
    aggregate.  A flow without its own amount uses ``amount``."""
    structs = []
    for flow in flows:
        label, pred, ev = flow[:3]
        amt = flow[3] if len(flow) > 3 else amount
        structs.append(F.when(pred & ev.isNotNull(), F.struct(
            F.date_format(ev, "yyyy-MM").alias(month_name), F.lit(label).alias(type_name), amt.alias("__amount"))))
    rows = df.select(F.inline(F.array_compact(F.array(*structs))))
    return rows.groupBy(month_name, type_name).agg(F.sum("__amount").alias(sum_name))
