"""A job that is killed between stages goes on where it stopped."""

import uuid

import pytest

from ledgerline.plans import jobs as J
from ledgerline.plans.inputs import fixture_inputs
from ledgerline.plans.runlog import RunLog
from ledgerline.registry import MONTH_CLOSE
from ledgerline.session import scratch_path

SMALL = "/root/testdata/sf0.001"


def test_stages_of_an_unfinished_run_are_not_repeated(spark):
    table, seen = f"log_{uuid.uuid4().hex[:6]}", []

    def work(name, fails=False):
        def go():
            if fails:
                raise RuntimeError(name)
            seen.append(name)
            return [name, 1]

        return go

    log = RunLog(spark, table, "job 1")
    assert log.stage("a", work("a")) == ["a", 1]
    with pytest.raises(RuntimeError, match="b"):
        log.stage("b", work("b", fails=True))
    again = RunLog(spark, table, "job 1")
    assert again.run == log.run and again.stage("a", work("a")) == ["a", 1] and again.stage("b", work("b")) == ["b", 1]
    again.finish()
    assert seen == ["a", "b"]
    # a finished run is not resumed, and another key is another run
    assert RunLog(spark, table, "job 1").done == {} and RunLog(spark, table, "job 2").done == {}


def test_income_job_resumes_at_the_first_stage_not_done(spark, monkeypatch):
    t = J.IncomeTables().prefixed(f"k{uuid.uuid4().hex[:6]}_")
    locations = {f: scratch_path(spark, f) for f in t.__dataclass_fields__}
    table, key = f"log_{uuid.uuid4().hex[:6]}", J.income_run_key(MONTH_CLOSE)
    writes, months, full = [], J.write_months, J.full_refresh
    monkeypatch.setattr(J, "write_months", lambda df, name, *a, **k: (writes.append(name), months(df, name, *a, **k))[1])

    def killed(df, name, **k):
        if name == t.settlement and len(writes) < 4:
            writes.append("killed")
            raise RuntimeError("killed")
        writes.append(name)
        return full(df, name, **k)

    monkeypatch.setattr(J, "full_refresh", killed)
    published = []
    go = lambda: J.run_income_job(spark, fixture_inputs(spark, SMALL), MONTH_CLOSE, t, locations=locations, log=RunLog(spark, table, key), publish=lambda df, name: published.append(name))
    with pytest.raises(RuntimeError, match="killed"):
        go()
    assert writes == [t.truck, t.bus, t.ledger, "killed"] and not published
    go()
    assert writes[4:] == [t.settlement, t.other, t.other_summary, t.debit_refund, t.aftersales, t.aftersales_summary]
    assert sorted(published) == sorted([t.waiver, t.summary, t.other_summary, t.debit_refund, t.aftersales_summary])
    assert spark.table(t.summary).count() > 0
    assert RunLog(spark, table, key).done == {}
