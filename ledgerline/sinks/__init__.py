"""Sinks (K1-K7): the only side-effecting functions of the library.

All writes are repeatable: running a job twice leaves the same target.
Partitioned targets are replaced partition by partition with Spark's
dynamic partition overwrite, set on the session around the write (the
writer option is ignored by ``insertInto``) and restored afterwards.
"""

from __future__ import annotations

import os
import re
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_root

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    prev = spark.conf.get(OVERWRITE_MODE, None)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        if prev is None:
            spark.conf.unset(OVERWRITE_MODE)
        else:
            spark.conf.set(OVERWRITE_MODE, prev)


def _quote(v: str) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def clustered(df: DataFrame, partition_col: str) -> DataFrame:
    """Group rows of one partition value into few, evenly sized tasks before a
    partitioned write (AQE rebalance: big partition values are split, small
    ones coalesced), so each output partition gets few files of target size
    instead of one small file per task."""
    return df.hint("rebalance", partition_col)


def create_partitioned(df: DataFrame, table: str, partition_col: str, path: str | None = None,
                       fmt: str = "parquet") -> None:
    """K7: initial create of a partitioned table (rebuild); replaces the table."""
    w = clustered(df, partition_col).write.mode("overwrite").format(fmt).partitionBy(partition_col)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


def create_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str | None = None,
                    fmt: str = "parquet") -> None:
    """A table bucketed and sorted by ``keys``: tables with as many buckets on their join
    keys are joined without a shuffle.  The rebalance hint, over as many partitions as
    buckets, gathers a bucket's rows in few tasks, so in few files, and splits a bucket
    with a hot key over several files."""
    w = df.hint("rebalance", buckets, *keys).write.mode("overwrite").format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)


PREVIOUS = "ledgerline.previous"


def full_refresh(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet") -> None:
    """K1: replace the whole table.

    The rows are written to a new version folder, under ``path`` or beside the
    warehouse's tables, and then the table's location is switched in one catalog step.
    Until then readers see the old version, so a write that fails changes nothing, and a
    query that reads the table may refresh it.  The version before the current one
    stays for readers that began with it; older ones are removed.  A table with other
    columns, or one that was not written this way, is replaced after the write.
    """
    spark = df.sparkSession
    root = path or os.path.join(spark.conf.get("spark.sql.warehouse.dir"), f"{table}.versions")
    version = os.path.join(root, f"v-{uuid.uuid4().hex}")
    try:
        df.write.format(fmt).save(version)
    except Exception:
        _remove(spark, version)
        raise
    switched = False
    if spark.catalog.tableExists(table):
        same = spark.table(table).schema.simpleString() == spark.read.format(fmt).load(version).schema.simpleString()
        current, previous = _version_paths(spark, table, root)
        switched = same and current is not None
        if switched:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_quote(version)}")
            spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_quote(PREVIOUS)} = {_quote(current)})")
            if previous:
                _remove(spark, previous)
    if not switched:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.catalog.createTable(table, path=version, source=fmt)
    spark.catalog.refreshTable(table)


def _version_paths(spark: SparkSession, table: str, root: str) -> tuple[str | None, str | None]:
    """The current and the previous version folder of a table under ``root``."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    folder = lambda p: p if p and "/v-" in p and _plain(p).startswith(_plain(root) + "/v-") else None
    previous = [r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect() if r["key"] == PREVIOUS]
    return folder(rows.get("Location")), folder(previous[0] if previous else None)


def _plain(path: str) -> str:
    """A path without its scheme."""
    return re.sub(r"^[a-z0-9]+:/*", "/", path)


def _remove(spark: SparkSession, folder: str) -> None:
    """Delete a version folder in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def overwrite_partitions(df: DataFrame, table: str, partition_col: str = "month", clear=()) -> list:
    """K2: replace exactly the partitions ``df`` has rows for; columns are
    matched by name to the target.

    ``clear`` lists the partitions of the run's window that must end up
    holding only the new rows; one that receives no new rows is emptied
    (dynamic overwrite alone would leave it untouched, Q18).  The write itself
    counts the rows of those partitions; only after it succeeds are the empty
    ones dropped.  ``df`` may read the target (the self-correction arm does):
    then, and only then, the new rows are checkpointed to the shared folder
    first.  Re-running gives the same target.  Returns the partition values that the
    run owned or wrote, of which there are few.
    """
    spark = df.sparkSession
    cols = spark.table(table).columns
    data = df.select(*cols)
    if _reads(df, table):
        checkpoint_root(spark)
        data = data.checkpoint(eager=True)
    seen = Observation()
    counts = [F.count(F.when(F.col(partition_col) == v, 1)).alias(f"n{i}") for i, v in enumerate(clear)]
    data = data.observe(seen, F.collect_set(F.col(partition_col)).alias("written"), *counts)
    with dynamic_overwrite(spark):
        clustered(data, partition_col).write.mode("overwrite").insertInto(table)
    written = seen.get
    for i, value in enumerate(clear):
        if not written.get(f"n{i}"):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_col} = {_quote(value)})")
    return sorted({*clear, *written["written"]})


def _root_paths(df: DataFrame) -> set[str]:
    """Root folders of the file relations in the analysed plan; no file is listed."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() != "LogicalRelation":
            continue
        relation = leaf.relation()
        if relation.getClass().getSimpleName() == "HadoopFsRelation":
            paths = relation.location().rootPaths()
            out.update(paths.apply(k).toString().rstrip("/") for k in range(paths.size()))
    return out


def _reads(df: DataFrame, table: str) -> bool:
    """Whether the plan reads the table it is to be written to: its root folder, or a
    folder inside it."""
    target = _root_paths(df.sparkSession.table(table))
    return any(p == t or p.startswith(t + "/") for p in _root_paths(df) for t in target)


def replace_day(df: DataFrame, table: str, day: str, partition_col: str = "bz_date", path: str | None = None,
                fmt: str = "parquet") -> None:
    """K3 + K4: make partition ``day`` hold exactly ``df``'s rows.

    Creates the table (partitioned, append) on first use; afterwards
    overwrites only that day's partition, so a second run leaves one copy.
    """
    spark = df.sparkSession
    rows = df.where(df[partition_col] == day)
    if not spark.catalog.tableExists(table):
        w = rows.write.mode("append").format(fmt).partitionBy(partition_col)
        if path:
            w = w.option("path", path)
        w.saveAsTable(table)
        return
    cols = spark.table(table).columns
    with dynamic_overwrite(spark):
        rows.select(*cols).write.mode("overwrite").insertInto(table)


def publish_jdbc(df: DataFrame, url: str, table: str, properties: dict, max_connections: int = 8,
                 batch_size: int = 10_000) -> None:
    """K5: publish a summary to a serving database (truncate + insert).

    Connection details come from the caller; nothing is embedded here.  At
    most ``max_connections`` tasks write at once (Spark's JDBC writer
    coalesces to ``numPartitions``), so a large cluster cannot open one
    connection per partition against the serving database; rows are sent in
    batches of ``batch_size``.
    """
    (df.write.mode("overwrite").option("truncate", "true")
     .option("numPartitions", str(max_connections)).option("batchsize", str(batch_size))
     .jdbc(url=url, table=table, properties=properties))


def extract_csv(df: DataFrame, path: str) -> None:
    """K6: a detail extract for people, written in parallel as CSV files with
    a header (no collect to the driver).  The extract keeps one day of a large
    plan, so it is rebalanced first (AQE sizes the partitions): a few files of
    sensible size instead of one tiny file per upstream partition."""
    df.hint("rebalance").write.mode("overwrite").option("header", "true").csv(path)
