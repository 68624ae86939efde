"""Rule tables kept as data (P13, P15, P16 general form).

``equality_rule`` looks a value up in a rule table by equality on one or more
keys; ``prefix_rule`` does the same on the first ``n`` characters of a column.
The rule table is made unique per key (deterministic: the smallest value
wins), so a lookup never multiplies rows.  The joins are plain equi-joins:
Spark sizes the rule side and broadcasts it under its own bound, or shuffles.
Building a lookup runs no job.  Rows whose key is NULL or unmatched get
``default``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.joins import spread_null_key

def equality_rule(df: DataFrame, rules: DataFrame, on: list[str], out: str, default=None,
                  rule_keys: list[str] | None = None) -> DataFrame:
    """Add column ``out`` = the rule table's ``out`` where ``df[on] == rules[rule_keys]``."""
    rule_keys = rule_keys or on
    r = (rules.groupBy(*[F.col(k).alias(f"__r{i}") for i, k in enumerate(rule_keys)])
         .agg(F.min(out).alias("__value")))
    keyed = df.select("*", *[spread_null_key(df, c).alias(f"__l{i}") for i, c in enumerate(on)])
    cond = reduce(lambda a, b: a & b, [keyed[f"__l{i}"] == r[f"__r{i}"] for i in range(len(on))])
    joined = keyed.join(r, cond, "left")
    value = F.col("__value") if default is None else F.coalesce(F.col("__value"), F.lit(default))
    return joined.select(*[keyed[c] for c in df.columns], value.alias(out))


def prefix_rule(df: DataFrame, column: str, n: int, rules: DataFrame, out: str, default=None,
                rule_key: str = "prefix") -> DataFrame:
    """Add column ``out`` looked up by the first ``n`` characters of ``column``."""
    keyed = df.withColumn("__prefix", F.substring(F.col(column), 1, n))
    out_df = equality_rule(keyed, rules, ["__prefix"], out, default, rule_keys=[rule_key])
    return out_df.drop("__prefix")


def rules_frame(spark, rows: dict, key: str, out: str) -> DataFrame:
    """A two-column rule table from a mapping (for rule data kept in code)."""
    return spark.createDataFrame(list(rows.items()), f"{key} string, {out} string")


def rate_from_table(df: DataFrame, rates: DataFrame, key: str, day: str, out: str, rate_key: str = "key") -> DataFrame:
    """P20, general form: the rate valid on ``day`` from a table of versions
    ``(rate_key, valid_from, valid_to, rate)``; ``valid_to`` is exclusive and
    NULL means open-ended.  Rows with no valid version, or a NULL key, get NULL.

    The versions of a key become one array sorted by date, joined by key alone and
    searched for the last version that began: no fan-out and no range condition in the
    join.  Versions of a key that overlap raise an error that names the key; a version
    without a beginning, or one that ends before it begins, is never valid.
    """
    began = rates.where(F.col(rate_key).isNotNull() & F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))
    version = F.struct(F.col("valid_from").alias("begin"), F.col("valid_to").alias("end"), F.col("rate").alias("rate"))
    r = began.groupBy(F.col(rate_key).alias("__rk")).agg(F.sort_array(F.collect_list(version)).alias("versions"))
    n = F.size("versions")
    crossing = F.zip_with(F.slice("versions", 1, n - 1), F.slice("versions", 2, n - 1), lambda a, b: a["end"].isNull() | (a["end"] > b["begin"]))
    error = F.raise_error(F.concat(F.lit("overlapping rate versions of key "), F.col("__rk").cast("string")))
    checked = F.when(F.exists(crossing, lambda x: x), error.cast(r.schema["versions"].dataType)).otherwise(F.col("versions"))
    r = r.select("__rk", checked.alias("__versions"))
    keyed = df.select("*", spread_null_key(df, key).alias("__lk"), F.to_date(F.col(day)).alias("__day"))
    joined = keyed.join(r, keyed["__lk"] == r["__rk"], "left")
    last = F.try_element_at(F.filter("__versions", lambda v: v["begin"] <= F.col("__day")), F.lit(-1))
    rate = F.when(last["end"].isNull() | (F.col("__day") < last["end"]), last["rate"])
    return joined.select(*[keyed[c] for c in df.columns], rate.alias(out))
