"""Session helpers: read cluster settings, set defaults only where unset."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults for this library's plans.  They are applied only when the key is
# not already set, so a cluster's own configuration always wins.
PLAN_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Static broadcasts keep Spark's own bound (10 MB by estimate), so a small
    # dimension does not cost a shuffle of the large side; AQE may broadcast a
    # side whose shuffle stage measured below this bound.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Ledger event times are timestamp_ntz in the inputs; the zone matters
    # only where a caller supplies zoned timestamps.
    "spark.sql.session.timeZone": "UTC",
}


def apply_defaults(spark: SparkSession, defaults: dict | None = None) -> None:
    for key, value in (defaults or PLAN_DEFAULTS).items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be shared storage set by the cluster: without it
    this raises.  Only a local session (tests), whose driver and executors are
    one process, gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    try:  # a classic session; a Spark Connect session has no SparkContext
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect raises a session-specific error
        sc = None
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), "ledgerline", f"{name}-{uuid.uuid4().hex[:12]}")


def test_session(app: str = "ledgerline-tests", cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark
