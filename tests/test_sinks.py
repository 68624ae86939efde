"""Sinks: dynamic partition overwrite keeps neighbours, re-runs are
idempotent, window months with no new rows are emptied (Q18)."""

import uuid
from datetime import date

from pyspark.sql import functions as F

from ledgerline import sinks as K
from ledgerline.session import scratch_path


def _table(spark, rows):
    name = f"t_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame(rows, "v int, month string")
    K.create_partitioned(df, name, "month", path=scratch_path(spark, name))
    return name


def _rows(spark, name):
    return sorted(tuple(r) for r in spark.table(name).collect())


def test_neighbour_partition_survives_and_rerun_is_idempotent(spark):
    name = _table(spark, [(1, "2001-06"), (2, "2001-07"), (3, "2001-08")])
    new = spark.createDataFrame([(20, "2001-07")], "v int, month string")
    for _ in range(2):
        K.overwrite_partitions(new, name, "month")
        assert _rows(spark, name) == [(1, "2001-06"), (3, "2001-08"), (20, "2001-07")]
    # the session mode is restored
    assert spark.conf.get(K.OVERWRITE_MODE, "static") != "dynamic"


def test_window_month_without_new_rows_is_cleared(spark):
    name = _table(spark, [(1, "2001-06"), (2, "2001-07"), (3, "2001-08")])
    new = spark.createDataFrame([(30, "2001-08")], "v int, month string")
    K.overwrite_partitions(new, name, "month", clear=["2001-07", "2001-08"])
    assert _rows(spark, name) == [(1, "2001-06"), (30, "2001-08")]


def test_replace_day_twice_keeps_one_copy(spark):
    name = f"d_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1.5, "a", "20010101"), (2.5, "b", "20010101")], "amount double, label string, bz_date string")
    other = spark.createDataFrame([(9.0, "z", "20001231")], "amount double, label string, bz_date string")
    path = scratch_path(spark, name)
    K.replace_day(other, name, "20001231", path=path)
    for _ in range(2):
        K.replace_day(df, name, "20010101", path=path)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [
        (1.5, "a", "20010101"), (2.5, "b", "20010101"), (9.0, "z", "20001231")]


def test_extract_csv_round_trip(spark):
    df = spark.createDataFrame([(date(2001, 1, 1), 1.25, "x")], "d date, v double, s string")
    path = scratch_path(spark, "csv")
    K.extract_csv(df, path)
    back = spark.read.option("header", "true").schema(df.schema).csv(path)
    assert back.collect() == df.collect()


def test_rewrite_that_reads_its_own_target(spark):
    name = _table(spark, [(1, "2001-06"), (2, "2001-07"), (3, "2001-08")])
    new = spark.table(name).where(F.col("month") >= "2001-07").select((F.col("v") * 10).alias("v"), "month") \
        .where(F.col("month") == "2001-07")
    K.overwrite_partitions(new, name, "month", clear=["2001-07", "2001-08"])
    assert _rows(spark, name) == [(1, "2001-06"), (20, "2001-07")]


def test_rebuild_of_listed_months_only(spark):
    from datetime import date as d

    from ledgerline.context import RunContext
    from ledgerline.plans.jobs import write_months

    name = _table(spark, [(1, "2001-06"), (2, "2001-07"), (3, "2001-08")])
    rebuilt = spark.createDataFrame([(60, "2001-06"), (70, "2001-07"), (80, "2001-08")], "v int, month string")
    write_months(rebuilt, name, RunContext(as_of=d(2001, 8, 2)), "rebuild", months=["2001-07"])
    assert _rows(spark, name) == [(1, "2001-06"), (3, "2001-08"), (70, "2001-07")]


def test_full_refresh_switches_versions_and_survives_a_failure(spark):
    """A write that fails half-way leaves the old table; a refresh may read its own table;
    one version before the current one is kept."""
    import glob

    import pytest

    name = f"v_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, name)
    make = lambda *values: spark.createDataFrame([(v,) for v in values], "v int")
    K.full_refresh(make(1, 2), name, path=path)
    bad = make(7, 8, 9).repartition(3).select(F.when(F.col("v") == 9, F.raise_error(F.lit("lost")).cast("int")).otherwise(F.col("v")).alias("v"))
    with pytest.raises(Exception, match="lost"):
        K.full_refresh(bad, name, path=path)
    assert _rows(spark, name) == [(1,), (2,)]
    K.full_refresh(spark.table(name).select((F.col("v") * 10).alias("v")), name, path=path)
    assert _rows(spark, name) == [(10,), (20,)]
    for i in range(3):
        K.full_refresh(make(i), name, path=path)
        assert _rows(spark, name) == [(i,)]
    assert len(glob.glob(f"{path}/v-*")) == 2  # nothing is left of the failed write
    # other columns: the table is replaced after the write
    K.full_refresh(spark.createDataFrame([("a", 1)], "w string, v int"), name, path=path)
    assert spark.table(name).columns == ["w", "v"] and spark.table(name).count() == 1
    K.full_refresh(make(), name + "e")
    assert spark.table(name + "e").count() == 0
