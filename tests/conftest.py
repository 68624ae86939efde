"""Shared fixtures: one local Spark session (UI off, UTC, its own warehouse and
checkpoint folders) and a DuckDB connection over the sf0.01 tables."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = os.environ.get("LEDGERLINE_TEST_SF", "/root/testdata/sf0.01")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from ledgerline.session import apply_defaults

    s = (SparkSession.builder.master("local[4]").appName("ledgerline-tests")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    apply_defaults(s)
    yield s


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck_con():
    from compare import duck

    return duck(SF)
