"""Adjustment arms of the ledger merge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schema import check_schema, conform


def ledger_shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A hand-loaded correction table already shaped like the ledger;
    selected by name and checked, never by position."""
    return check_schema(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]), schema)


@dataclass
class Admitted:
    """A hand-loaded table after its check: rows with the declared types, and rejects
    ``(input, raw, reasons)`` with the row as JSON."""

    good: DataFrame
    rejects: DataFrame


def admit(df: DataFrame, name: str, schema: T.StructType, required: tuple[str, ...] = ()) -> Admitted:
    """Hand-loaded rows checked against ``schema``.

    A value that its declared type cannot hold, and a missing ``required`` value, put
    the row among the rejects with one reason each; it neither fails the job nor becomes
    NULL in the ledger.  Columns beyond the schema pass with the good rows; a column that
    the table lacks altogether raises."""
    if missing := [f.name for f in schema.fields if f.name not in df.columns]:
        raise ValueError(f"input {name!r} lacks the columns {', '.join(missing)}")
    reasons = []
    for f in schema.fields:
        raw, kind = F.col(f.name), f.dataType.simpleString()
        if df.schema[f.name].dataType != f.dataType:
            shown = F.concat(F.lit(f"{f.name}: not {kind}: "), raw.cast("string"))
            reasons.append(F.when(raw.isNotNull() & raw.try_cast(f.dataType).isNull(), shown))
        if f.name in required:
            reasons.append(F.when(raw.isNull(), F.lit(f"{f.name}: missing")))
    found = F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")
    bad = F.size(found) > 0
    types = {f.name: f.dataType for f in schema.fields}
    good = df.where(~bad).select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    return Admitted(good, df.where(bad).select(F.lit(name).alias("input"), F.to_json(F.struct(*df.columns)).alias("raw"), found.alias("reasons")))


def constant_rows(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """One-row (or few-row) constant corrections with a declared schema."""
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def adjustment(df: DataFrame, values: dict, schema: T.StructType, where: Column | None = None) -> DataFrame:
    """An adjustment file whose labels need mapping (recode, direction)."""
    x = df.where(where) if where is not None else df
    return conform(x, values, schema)


def self_correction(ledger: DataFrame, ids: list[str], where: Column, values: dict,
                    schema: T.StructType) -> DataFrame:
    """Corrections derived from the ledger that is being rewritten.

    The id list is a literal IN list (small, fixed); the read is a normal
    scan of the current target, legal because the sink overwrites partitions
    dynamically (only the partitions written are replaced, at commit).
    """
    x = ledger.where(F.col("obu_id").isin(ids) & where)
    return conform(x, values, schema)
