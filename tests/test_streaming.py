"""The landed-day trigger runs each new day once and remembers progress."""

from ledgerline.session import scratch_path
from ledgerline.streaming import run_landed_days, write_marker


def test_each_landed_day_runs_once(spark):
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "stream-ckpt")
    seen = []
    write_marker(spark, landing, "20010731")
    write_marker(spark, landing, "20010801")
    run_landed_days(spark, landing, lambda ctx: seen.append(ctx.ds), checkpoint=ckpt)
    assert seen == ["20010731", "20010801"]
    run_landed_days(spark, landing, lambda ctx: seen.append(ctx.ds), checkpoint=ckpt)
    assert seen == ["20010731", "20010801"]
    write_marker(spark, landing, "20010802")
    run_landed_days(spark, landing, lambda ctx: seen.append(ctx.ds), checkpoint=ckpt)
    assert seen == ["20010731", "20010801", "20010802"]


def test_landed_day_runs_the_cost_job(spark):
    import uuid

    from ledgerline.plans import jobs as J
    from ledgerline.plans.inputs import fixture_inputs

    t = J.CostTables().prefixed(f"s{uuid.uuid4().hex[:6]}_")
    locations = {f: scratch_path(spark, f) for f in ("detail", "deposits", "profit")}
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "stream-ckpt")
    write_marker(spark, landing, "19980302")
    run_landed_days(spark, landing, lambda ctx: J.run_cost_job(
        spark, fixture_inputs(spark, "/root/testdata/sf0.001"), ctx, t, locations=locations), checkpoint=ckpt)
    days = {r[0] for r in spark.table(t.deposits).select("bz_date").collect()}
    assert days == {"19980301"}
    assert spark.table(t.profit).count() > 0
