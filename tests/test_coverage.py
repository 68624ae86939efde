"""Snapshot coverage: a run without a closing snapshot raises before it writes."""

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerline.context import RunContext
from ledgerline.plans import jobs as J
from ledgerline.plans.bus import bus_ledger
from ledgerline.plans.inputs import catalog_inputs, fixture_inputs
from ledgerline.plans.truck import truck_ledger
from ledgerline.registry import MONTH_CLOSE
from ledgerline.session import scratch_path
from ledgerline.sources import coverage
from ledgerline.sources import fixtures as fx

SMALL = "/root/testdata/sf0.001"


def _all_rows(spark, tables):
    return {t: sorted(map(tuple, spark.table(t).collect()), key=repr) for t in tables}


def test_closing_days_of_a_run():
    assert coverage.closing_days(MONTH_CLOSE, "incremental") == {"2001-07": "20010801", "2001-08": "20010801"}
    assert coverage.closing_days(MONTH_CLOSE, "rebuild", ["2001-05"]) == {"2001-05": "20010601"}
    assert list(coverage.closing_days(MONTH_CLOSE, "rebuild")) == ["2001-05", "2001-06", "2001-07", "2001-08"]


def test_manifest_reads_the_catalog_and_frames_alike(spark):
    name = f"cov_{uuid.uuid4().hex[:6]}"
    snap = fx.fx_snapshot(spark, SMALL).where("ds <> '20010701'")
    snap.write.partitionBy("ds").option("path", scratch_path(spark, name)).saveAsTable(name)
    inputs = catalog_inputs(spark, {"a": name, "b": name})
    inputs["c"] = snap
    wanted = {"2001-05": "20010601", "2001-06": "20010701"}
    got = coverage.manifest(spark, inputs, {"A": "a", "B": "b", "C": "c"}, wanted)
    assert [(c.feed, c.month, c.present) for c in got] == [(f, m, m == "2001-05") for f in "ABC" for m in ("2001-05", "2001-06")]
    # the catalog alone answers: an added empty partition counts without a file to read
    assert coverage.partition_days(spark, name, {"20010701"}) == set()
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (ds = '20010701')")
    assert coverage.partition_days(spark, name, {"20010701"}) == {"20010701"}
    plain = f"{name}_plain"
    snap.write.option("path", scratch_path(spark, plain)).saveAsTable(plain)
    assert coverage.partition_days(spark, plain, {"20010601"}) is None


def test_rebuild_of_a_ledger_without_a_closing_snapshot_raises(spark):
    for ledger, feed in ((truck_ledger, "T4_new_paid"), (bus_ledger, "U10_after_sales_decrease")):
        inputs = fixture_inputs(spark, SMALL)
        ledger(inputs, MONTH_CLOSE, "rebuild")
        inputs[feed] = inputs[feed].where("ds <> '20010701'")
        with pytest.raises(coverage.MissingSnapshots, match=feed) as e:
            ledger(inputs, MONTH_CLOSE, "rebuild")
        assert [(g.feed, g.month, g.ds) for g in e.value.gaps] == [(feed, "2001-06", "20010701")]


def test_job_without_a_closing_snapshot_leaves_every_table(spark):
    """The truck, bus and merged ledgers and all reports are as before the failed run."""
    t = J.IncomeTables().prefixed(f"v{uuid.uuid4().hex[:6]}_")
    names = [getattr(t, f) for f in t.__dataclass_fields__]
    locations = {f: scratch_path(spark, f) for f in t.__dataclass_fields__}
    J.run_income_job(spark, fixture_inputs(spark, SMALL), MONTH_CLOSE, t, mode="rebuild", locations=locations)
    before = _all_rows(spark, names)
    months = {r["month"] for r in spark.table(t.truck).select("month").distinct().collect()}
    assert "2001-06" in months
    inputs = fixture_inputs(spark, SMALL)
    gone = inputs["T1_signing"].where("ds <> '20010701'")
    for kw in ({"mode": "rebuild"}, {"mode": "rebuild", "months": ["2001-06"]}):
        inputs = fixture_inputs(spark, SMALL)
        inputs["T1_signing"] = gone
        with pytest.raises(coverage.MissingSnapshots, match="2001-06"):
            J.run_income_job(spark, inputs, MONTH_CLOSE, t, locations=locations, **kw)
        assert _all_rows(spark, names) == before
    # another month can be closed again, and a feed may be excused
    inputs = fixture_inputs(spark, SMALL)
    inputs["T1_signing"] = gone
    J.run_income_job(spark, inputs, MONTH_CLOSE, t, mode="rebuild", months=["2001-07"], locations=locations)
    assert _all_rows(spark, [t.truck]) == {t.truck: before[t.truck]}
    # a day whose own snapshot has not arrived would empty the current month
    with pytest.raises(coverage.MissingSnapshots, match="20010803"):
        J.run_income_job(spark, fixture_inputs(spark, SMALL), RunContext(as_of=date(2001, 8, 3)), t, locations=locations)
    assert _all_rows(spark, [t.truck]) == {t.truck: before[t.truck]}


def test_rebuild_leaves_months_before_its_first(spark):
    """Plain-table feeds have rows of older months; a rebuild does not write those."""
    t = J.IncomeTables().prefixed(f"w{uuid.uuid4().hex[:6]}_")
    locations = {f: scratch_path(spark, f) for f in t.__dataclass_fields__}
    J.run_income_job(spark, fixture_inputs(spark, SMALL), MONTH_CLOSE, t, mode="rebuild", locations=locations)
    old = lambda n: sorted(map(tuple, spark.table(n).where(F.col("month") < "2001-07").collect()), key=repr)
    before = {n: old(n) for n in (t.truck, t.bus)}
    assert all(before.values())
    J.run_income_job(spark, fixture_inputs(spark, SMALL), RunContext(as_of=date(2001, 8, 1), first_close="20010801"), t, mode="rebuild", locations=locations)
    assert {n: old(n) for n in before} == before
