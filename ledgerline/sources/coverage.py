"""Snapshot coverage of a run.

A run replaces the months it owns, so every snapshot source has to hold the snapshot
that closes each of them: without it the month would be rewritten from what is left.
The manifest of sources, months and closing snapshots is made before anything is
written.  For a catalog table it is read from the catalog's partition list; for a
frame, from the distinct snapshot days among those wanted, all sources in one job.
Either way the driver gets at most one row per source and wanted day.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.context import RunContext


@dataclass(frozen=True)
class Closing:
    """A month of a feed, the snapshot that closes it, and whether its source has it."""

    feed: str
    month: str
    ds: str
    present: bool


class MissingSnapshots(ValueError):
    """Raised before anything is written; ``gaps`` lists what is missing."""

    def __init__(self, gaps: list[Closing]):
        self.gaps = gaps
        months = sorted({g.month for g in gaps})
        feeds = "; ".join(f"{g.feed}: {g.month} ({g.ds})" for g in gaps)
        super().__init__(f"no snapshot closes {', '.join(months)}; these months cannot be rebuilt ({feeds})")


def closing_days(ctx: RunContext, mode: str, months: list[str] | None = None) -> dict[str, str]:
    """The months that a run owns and the snapshot that closes each."""
    owned = ctx.window_months if mode == "incremental" else (months or ctx.rebuild_months)
    return {m: ctx.closing_ds(m) for m in owned}


def partition_days(spark: SparkSession, table: str, days: set[str], ds: str = "ds") -> set[str] | None:
    """Of ``days`` those that the catalog lists as partitions of ``table``; None if the
    table is not partitioned by ``ds``."""
    if not any(c.isPartition and c.name == ds for c in spark.catalog.listColumns(table)):
        return None
    day = F.regexp_extract("partition", rf"(?:^|/){ds}=([^/]*)", 1)
    rows = spark.sql(f"SHOW PARTITIONS {table}").select(day.alias("day")).where(F.col("day").isin(sorted(days))).distinct().collect()
    return {r["day"] for r in rows}


def frame_days(frames: dict[str, DataFrame], days: set[str], ds: str = "ds") -> dict[str, set[str]]:
    """The same for frames, by name, in one job that reads the day column only."""
    if not frames:
        return {}
    parts = [f.where(F.col(ds).isin(sorted(days))).select(F.lit(n).alias("name"), F.col(ds).alias("day")).distinct() for n, f in frames.items()]
    out: dict[str, set[str]] = {n: set() for n in frames}
    for r in reduce(lambda a, b: a.unionByName(b), parts).collect():
        out[r["name"]].add(r["day"])
    return out


def manifest(spark: SparkSession, inputs, feeds: dict[str, str], wanted: dict[str, str]) -> list[Closing]:
    """One entry per feed and month of ``wanted`` (month -> closing day).  ``feeds`` maps
    a feed to the input that it reads; inputs of one origin are looked up once."""
    days = set(wanted.values())
    tables = getattr(inputs, "tables", {})
    origin = {feed: inputs.origin(name) if hasattr(inputs, "origin") else name for feed, name in feeds.items()}
    have: dict[str, set[str]] = {}
    frames: dict[str, DataFrame] = {}
    for feed, name in feeds.items():
        if origin[feed] in have or origin[feed] in frames:
            continue
        listed = partition_days(spark, tables[name], days) if name in tables else None
        if listed is None:
            frames[origin[feed]] = inputs[name]
        else:
            have[origin[feed]] = listed
    have |= frame_days(frames, days)
    return [Closing(feed, m, d, d in have[origin[feed]]) for feed in feeds for m, d in sorted(wanted.items())]


def require(spark: SparkSession, inputs, feeds: dict[str, str], ctx: RunContext, mode: str, months: list[str] | None = None) -> None:
    """Raise ``MissingSnapshots`` unless every feed can close every month the run owns."""
    gaps = [c for c in manifest(spark, inputs, feeds, closing_days(ctx, mode, months)) if not c.present]
    if gaps:
        raise MissingSnapshots(gaps)
