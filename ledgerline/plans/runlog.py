"""Run ledger: which stages of a job run have committed (K2, K3, the jobs).

Every stage of a job ends in one write.  After it, a marker row (run, stage, what the
stage returned) is appended to the run table.  A run that failed is resumed by its key,
which names the job and its parameters: stages with a marker are not run again, the
first one without is.  A marker is written after its write, so a failure between both
repeats that one write, and every write is repeatable.

A finished run has an end marker and is never resumed; the next run with its key is new.
The table has one small row per stage, so it is read on the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SCHEMA = "run string, stage string, result string, at timestamp, key string"
END = "end"


class RunLog:
    """The markers of one run of ``key``; the last unfinished one is resumed."""

    def __init__(self, spark: SparkSession, table: str, key: str, location: str | None = None):
        self.spark, self.table, self.key, self.location = spark, table, key, location
        rows = []
        if spark.catalog.tableExists(table):
            rows = spark.table(table).where(F.col("key") == key).orderBy("at").collect()
        ended = {r["run"] for r in rows if r["stage"] == END}
        open_runs = [r["run"] for r in rows if r["run"] not in ended]
        self.run = open_runs[-1] if open_runs else uuid.uuid4().hex
        self.done = {r["stage"]: json.loads(r["result"]) for r in rows if r["run"] == self.run}

    def stage(self, name: str, work: Callable):
        """What ``work()`` returned, now or in the run that is resumed."""
        if name not in self.done:
            result = work()
            self._mark(name, result)
        return self.done[name]

    def finish(self) -> None:
        self._mark(END, None)

    def _mark(self, stage: str, result) -> None:
        row = (self.run, stage, json.dumps(result), datetime.now(timezone.utc), self.key)
        w = self.spark.createDataFrame([row], SCHEMA).coalesce(1).write.mode("append").format("parquet").partitionBy("key")
        if self.location:
            w = w.option("path", self.location)
        w.saveAsTable(self.table)
        self.done[stage] = json.loads(row[2])


class NoLog:
    """Every stage runs."""

    def stage(self, name: str, work: Callable):
        return work()

    def finish(self) -> None:
        pass
