"""Run a daily batch job once per landed snapshot day (Structured Streaming)."""

from __future__ import annotations

import os
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.context import RunContext
from ledgerline.session import checkpoint_root

MARKER_SCHEMA = "ds string"


def write_marker(spark: SparkSession, landing: str, ds: str) -> None:
    """Upstream signal that snapshot ``ds`` is complete (one tiny JSON file)."""
    spark.createDataFrame([(ds,)], MARKER_SCHEMA).coalesce(1).write.mode("append").json(landing)


def run_landed_days(
    spark: SparkSession,
    landing: str,
    job: Callable[[RunContext], None],
    context: Callable[[str], RunContext] | None = None,
    checkpoint: str | None = None,
    name: str = "landed-days",
) -> None:
    """Process every marker not seen before, then stop (``availableNow``).

    ``job`` receives one RunContext per new day, in day order.  The batch of
    markers is a handful of day strings, so reading their distinct values on
    the driver is control flow, not data movement.
    """
    context = context or (lambda ds: RunContext(as_of=datetime.strptime(ds, "%Y%m%d").date()))
    checkpoint = checkpoint or os.path.join(checkpoint_root(spark), "ledgerline", "streams", name)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        days = sorted(r["ds"] for r in batch.select("ds").where(F.col("ds").isNotNull()).distinct().collect())
        for ds in days:
            job(context(ds))

    query = (spark.readStream.schema(MARKER_SCHEMA).json(landing)
             .writeStream.foreachBatch(each_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
