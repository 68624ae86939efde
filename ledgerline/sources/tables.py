"""Table access (S1): catalog names or Parquet folders, read lazily."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read ``name`` from a folder of Parquet tables, or from the catalog.

    ``root`` may be a directory holding ``<name>.parquet`` (the test data
    layout) or ``None``/``""`` for a catalog table.  Nothing is read until an
    action runs; filters and projections reach the scan.
    """
    if not root:
        return spark.table(name)
    path = os.path.join(root, f"{name}.parquet")
    return spark.read.parquet(path)
