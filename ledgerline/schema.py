"""Declared schemas and the conform step.

Every feed is projected onto a declared StructType by name and type, so
unions are by name, never by position, and a type drift fails early.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
NET = T.DecimalType(18, 6)

LEDGER = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("scene", T.StringType()),
        T.StructField("buyer", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("preinstall", T.StringType()),
        T.StructField("obu_id", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("adjust_type", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("scene2", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)

MERGED = T.StructType(LEDGER.fields[:-1] + [T.StructField("net_price", NET), LEDGER.fields[-1]])

#: the ledger as stored: the arm that an adjustment comes from, null for booked rows
ARM = "arm"
STORED = T.StructType(MERGED.fields[:-1] + [T.StructField(ARM, T.StringType()), MERGED.fields[-1]])


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in types.items()])


#: hand-loaded inputs: declared columns, and those that must not be missing
_DAY, _TEXT = T.DateType(), T.StringType()
HAND_LOADED = {
    "corrections": (MERGED, ("date", "month")),
    "corrections_second": (MERGED, ("date", "month")),
    "loaded_corrections": (MERGED, ("date", "month")),
    "adjust_file": (_columns(obu_id=_TEXT, price=MONEY, month=_TEXT), ()),
    "manual_income": (_columns(date=_DAY, scene2=_TEXT, price=MONEY, obu_id=_TEXT), ("date",)),
    "person_services": (_columns(date=_DAY, scene2=_TEXT, price=MONEY, obu_id=_TEXT), ("date",)),
    "person_scenes": (_columns(scene=_TEXT, price=MONEY, obu_id=_TEXT), ()),
    "live_adjustments": (_columns(date=_DAY, scene=_TEXT, money=MONEY, obu_id=_TEXT), ("date",)),
}

MOVEMENT = T.StructType(
    [
        T.StructField("data_type", T.StringType()),
        T.StructField("scene", T.StringType()),
        T.StructField("adjust_type", T.StringType()),
        T.StructField("sale_department", T.StringType()),
        T.StructField("service_scene2", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("obu_id", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("id", T.StringType()),
        T.StructField("ds", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)


def _as_column(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str) and v.startswith("@"):
        return F.col(v[1:])
    return F.lit(v)


def conform(df: DataFrame, values: dict, schema: T.StructType = LEDGER) -> DataFrame:
    """Select ``schema``'s columns in order, each cast to its declared type.

    ``values`` maps a column name to a Column, a literal, or ``"@name"`` for a
    source column.  Missing names become typed NULLs (P3).  ``month`` defaults
    to ``yyyy-MM`` of ``date`` (P4).
    """
    cols = []
    for f in schema.fields:
        if f.name in values:
            c = _as_column(values[f.name])
        elif f.name == "month" and "date" in values:
            c = F.date_format(_as_column(values["date"]).cast("date"), "yyyy-MM")
        else:
            c = F.lit(None)
        if isinstance(f.dataType, T.DateType):
            c = F.to_date(c)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def check_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Fail fast when ``df`` does not carry ``schema``'s names and types."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in schema.fields]
    if got != want:
        raise ValueError(f"schema mismatch:\n got  {got}\n want {want}")
    return df


def for_compare(df: DataFrame) -> DataFrame:
    """Output form of the registered queries (compared with another engine):
    decimals become doubles, dates become midnight ``timestamp_ntz``.

    Both are representation only.  A DATE reaches pandas as
    ``datetime.date`` from Spark but as a timestamp from DuckDB, while a naive
    timestamp looks the same from both engines and through both row and pandas
    paths.  The library's own tables keep DATE and DECIMAL.
    """
    if not any(isinstance(f.dataType, (T.DecimalType, T.DateType)) for f in df.schema.fields):
        return df
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)
