"""Join shapes used by the ledger.

None of these hints a broadcast: the right sides here are derived from data
and have no proven size bound.  With AQE on, Spark measures each shuffled
side at run time and turns a join into a broadcast join only when that side
is below the AQE broadcast threshold; otherwise it stays a sort-merge join.
Right sides are made unique per key first (distinct or aggregate), except
``resolve_id(unique=False)``, which keeps the modelled fan-out; so a hot key
on the left cannot multiply rows.

Such a unique right side is written to the shared checkpoint folder before the
join (``staged``).  Both sides of the join are then shuffled straight from
storage, which is the shape in which AQE can split a hot left partition; with
an aggregate between shuffle and join it cannot.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline import labels as L
from ledgerline.session import checkpoint_root

# NULL keys never match, but hashed together they would all land in one
# reducer.  They are replaced by a salt that cannot occur in real data (it
# starts with a NUL character) and is derived from the row's content, so it
# is deterministic under task retries and spreads NULL rows evenly.
NULL_SALT_PREFIX = "\u0000null-"
NULL_SALT_BUCKETS = 4096


def spread_null_key(df: DataFrame, key: str) -> Column:
    """Join key column for ``key`` that is never NULL (string keys only)."""
    c = df[key]
    if not isinstance(df.schema[key].dataType, T.StringType):
        return c
    salt = F.pmod(F.xxhash64(*[df[n] for n in df.columns]), F.lit(NULL_SALT_BUCKETS)).cast("string")
    return F.coalesce(c, F.concat(F.lit(NULL_SALT_PREFIX), salt))


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def restrict_to_keys(df: DataFrame, keys: DataFrame, left_on: list[str], right_on: list[str] | None = None) -> DataFrame:
    """Keep rows of ``df`` whose key occurs in ``keys`` (LEFT SEMI).

    Equivalent to an inner join with the grouped key set, without the
    aggregate; duplicates in ``keys`` cannot multiply rows.
    """
    right_on = right_on or left_on
    k = keys.select(*[F.col(r).alias(f"__k{i}") for i, r in enumerate(right_on)])
    cond = reduce(lambda a, b: a & b, [df[l] == k[f"__k{i}"] for i, l in enumerate(left_on)])
    return df.join(k, cond, "left_semi")


def restrict_to_members(df: DataFrame, keys: DataFrame, group: str, member: str) -> DataFrame:
    """J1 on two keys, shuffled by the first one only: keep rows of ``df`` whose
    ``(group, member)`` occurs in ``keys``.

    The keys become one row per ``group`` with its set of members, so a later join on
    ``group`` reuses the partitioning, and tables bucketed by ``group`` are not shuffled
    at all.  A group's set has to fit one row: take groups that ``hot_keys`` finds apart."""
    k = keys.where(F.col(group).isNotNull()).groupBy(F.col(group).alias("__group")).agg(F.collect_set(member).alias("__members"))
    return df.join(k, (df[group] == k["__group"]) & F.array_contains(k["__members"], df[member]), "left_semi")


#: a key that more than this share of the rows has is hot, so at most 256 keys are
HOT_SHARE = 1 / 256
HOT_TRACKED = 4096


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, least: int = 100_000) -> list:
    """Keys that more than ``share`` of the rows and at least ``least`` rows have: at most
    ``1 / share`` values.  One pass with a sketch of ``HOT_TRACKED`` counters a task; no
    shuffle of keys.  Null is never hot, as it matches nothing."""
    k = F.col(key)
    row = df.where(k.isNotNull()).agg(F.count("*").alias("n"), F.expr(f"approx_top_k(`{key}`, {int(1 / share)}, {HOT_TRACKED})").alias("top")).first()
    if not row["n"]:
        return []
    return [t["item"] for t in row["top"] if t["count"] > max(share * row["n"], least)]


def is_hot(key: Column, hot: list) -> Column:
    """Whether a key is one of ``hot``; never null."""
    return F.coalesce(key.isin(hot), F.lit(False)) if hot else F.lit(False)


def few_rows(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """A dimension for a join: broadcast if it was counted to have at most ``limit`` rows
    (some MB), else left for Spark to shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def flag_existence(df: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str], name: str,
                   yes: str = L.YES, no: str = L.NO) -> DataFrame:
    """J9 + P18: add ``name`` = yes/no for whether the key exists in ``right``."""
    marks = right.select(*[F.col(r).alias(f"__m{i}") for i, r in enumerate(right_on)]).distinct() \
        .withColumn("__hit", F.lit(True))
    keyed = df.select("*", *[spread_null_key(df, l).alias(f"__l{i}") for i, l in enumerate(left_on)])
    marks = staged(marks)
    cond = reduce(lambda a, b: a & b, [keyed[f"__l{i}"] == marks[f"__m{i}"] for i in range(len(left_on))])
    out = keyed.join(marks, cond, "left")
    return out.select(*[keyed[c] for c in df.columns],
                      F.when(F.col("__hit").isNotNull(), F.lit(yes)).otherwise(F.lit(no)).alias(name))


def attach_one_per_key(df: DataFrame, right: DataFrame, left_key: str, right_key: str,
                       values: dict[str, Column]) -> DataFrame:
    """J8 + A8: aggregate ``right`` to one row per key, then LEFT JOIN it."""
    agg = staged(right.groupBy(F.col(right_key).alias("__key")).agg(*[c.alias(n) for n, c in values.items()]))
    keyed = df.select("*", spread_null_key(df, left_key).alias("__lk"))
    out = keyed.join(agg, keyed["__lk"] == agg["__key"], "left")
    return out.drop("__key", "__lk")


def resolve_id(df: DataFrame, mapping: DataFrame, key: str, map_key: str, map_value: str,
               when: Column | None = None, unique: bool = False) -> DataFrame:
    """J4 + J5 + P12: replace ``key`` by the mapped id where a mapping exists.

    ``when`` limits the swap to some rows.  ``unique=False`` keeps the
    modelled behaviour: a key with several mappings fans out into several
    rows.  ``unique=True`` keeps one mapping per key (the smallest).
    """
    m = mapping.select(F.col(map_key).alias("__from"), F.col(map_value).alias("__to"))
    if unique:
        m = staged(m.groupBy("__from").agg(F.min("__to").alias("__to")))
    keyed = df.select("*", spread_null_key(df, key).alias("__lk"))
    joined = keyed.join(m, keyed["__lk"] == m["__from"], "left")
    swapped = F.coalesce(F.col("__to"), keyed[key])
    if when is not None:
        swapped = F.when(when, swapped).otherwise(keyed[key])
    return joined.select(*[swapped.alias(c) if c == key else keyed[c] for c in df.columns])


def attach_dimensions(df: DataFrame, key: str, dimensions: list[tuple[DataFrame, str, dict]]) -> DataFrame:
    """LEFT JOIN several right sides on ``key`` as one frame with one row per key.

    Each dimension is ``(frame, its key column, {output name: aggregate})``; an
    aggregate of None means "membership": a boolean column of that name.  The
    dimensions are aggregated, stacked and grouped to one row per key, staged, and
    joined once: one shuffle of the large table, split where a key is hot.
    """
    kinds = {}
    parts = []
    for right, right_key, values in dimensions:
        keyed = right.select(F.col(right_key).alias("__rk"), "*")
        aggs = [(F.lit(True) if c is None else c).alias(n) for n, c in values.items()]
        if all(c is None for c in values.values()):
            part = keyed.select("__rk").distinct().select("__rk", *aggs)
        else:
            part = keyed.groupBy("__rk").agg(*aggs)
        kinds |= {n: part.schema[n].dataType for n in values}
        parts.append(part.where(F.col("__rk").isNotNull()))
    stacked = reduce(lambda a, b: a.unionByName(b), [
        p.select("__rk", *[F.col(n) if n in p.columns else F.lit(None).cast(t).alias(n) for n, t in kinds.items()]) for p in parts
    ])
    one = staged(stacked.groupBy("__rk").agg(*[F.max(n).alias(n) for n in kinds]))
    keyed = df.select("*", spread_null_key(df, key).alias("__lk"))
    out = keyed.join(one, keyed["__lk"] == one["__rk"], "left")
    members = {n for _, _, values in dimensions for n, c in values.items() if c is None}
    return out.select(*[keyed[c] for c in df.columns], *[
        F.coalesce(one[n], F.lit(False)).alias(n) if n in members else one[n] for n in kinds
    ])
