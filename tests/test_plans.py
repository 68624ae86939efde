"""Plan shape: partition and pushed filters reach the scan, J1 is a semi
join, the movement arms scan their source once, no nested-loop joins."""

import pytest

from ledgerline.plans import services as S
from ledgerline.registry import MONTH_CLOSE, QUERIES
from ledgerline.sources import fixtures as fx
from ledgerline.sources.snapshot import snapshot_union


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def snapshot_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("snap") / "snapshot")
    fx.fx_snapshot(spark, "/root/testdata/sf0.001").write.partitionBy("ds").parquet(path)
    return spark.read.parquet(path)


def test_snapshot_slice_prunes_partitions_and_pushes_event_range(snapshot_table):
    df = snapshot_union(snapshot_table, "event_ts", MONTH_CLOSE).select("id", "price")
    p = plan(df)
    assert "PartitionFilters: [isnotnull(ds" in p and "(ds#" in p and "= 20010801)" in p
    assert "PushedFilters: [IsNotNull(event_ts), GreaterThanOrEqual(event_ts" in p
    assert "ReadSchema: struct<id:string,event_ts:timestamp_ntz,price:bigint>" in p


def test_rebuild_is_one_scan(snapshot_table):
    df = snapshot_union(snapshot_table, "event_ts", MONTH_CLOSE, mode="rebuild")
    assert plan(df).count("FileScan parquet") == 1


def test_restrict_to_keys_is_a_semi_join(spark, sf):
    p = plan(QUERIES["cost_semi_only"](spark, sf))
    assert "LeftSemi" in p and "HashAggregate" not in p


def test_movements_scan_source_once(spark, sf):
    p = plan(S.aftersales_movements(fx.fx_detail(spark, sf), MONTH_CLOSE))
    assert p.count("FileScan parquet") == 1
    assert p.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_nested_loop_cartesian_cap_or_sample(spark, sf, name):
    """No pair-emitting joins, and whole tables: no row cap, no sampling."""
    if name in ("overwrite_partitions", "replace_day", "full_refresh", "extract_csv", "cost_detail_colocated"):
        pytest.skip("sink query: writes on build")
    p = plan(QUERIES[name](spark, sf))
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "Limit" not in p and "Sample" not in p


def test_enrichment_shuffles_the_ledger_once(spark, sf):
    p = plan(QUERIES["enrich_department"](spark, sf))
    assert p.count("Exchange hashpartitioning(__lk") == 1


def test_merge_prunes_month_partitions_of_the_ledger_tables(spark, tmp_path):
    import uuid

    from pyspark.sql import functions as F

    from ledgerline import labels as L
    from ledgerline.plans.inputs import fixture_inputs
    from ledgerline.plans.merge import merge_ledger
    from ledgerline.schema import LEDGER, conform
    from ledgerline.sinks import create_partitioned

    small = "/root/testdata/sf0.001"
    base = conform(fx.fx_ledger(spark, small), {c: f"@{c}" for c in LEDGER.fieldNames()}, LEDGER)
    names = {}
    for seg in (L.TRUCK, L.BUS):
        names[seg] = f"p_{seg}_{uuid.uuid4().hex[:6]}"
        create_partitioned(base.where(F.col("segment") == seg), names[seg], "month", path=str(tmp_path / names[seg]))
    merged = merge_ledger(spark, fixture_inputs(spark, small), MONTH_CLOSE, spark.table(names[L.TRUCK]), spark.table(names[L.BUS]))
    p = plan(merged)
    assert p.count("PartitionFilters: [isnotnull(month") >= 2 and "(month#" in p and ">= 2001-07)" in p


def test_colocated_cost_join_does_not_shuffle_the_bills(spark, tmp_path):
    """On tables bucketed by statement, with no side small enough to broadcast but the
    checked product dimension, no row of the bills, lines or settlements is shuffled."""
    import uuid

    from ledgerline.operators.joins import few_rows
    from ledgerline.plans import cost as C
    from ledgerline.plans.inputs import fixture_inputs

    i = fixture_inputs(spark, "/root/testdata/sf0.001")
    names = tuple(f"{n}_{uuid.uuid4().hex[:6]}" for n in ("b", "l", "s"))
    C.store_by_statement(i["bill"], i["bill_lines"], i["settlement"], names, buckets=4, paths=tuple(str(tmp_path / n) for n in names))
    tables = [spark.table(n) for n in names]
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in (*limits, "spark.sql.sources.bucketing.enabled")}
    try:
        for k in limits:
            spark.conf.set(k, "-1")
        for pivot in (False, True):
            p = plan(C.bill_cost_detail(*tables, few_rows(i["product"]), pivot=pivot))
            assert "Exchange hashpartitioning" not in p and p.count("SortMergeJoin") == 2 and p.count("BroadcastExchange") == 1
        # read as plain tables, one shuffle of the bills serves both joins
        spark.conf.set("spark.sql.sources.bucketing.enabled", "false")
        p = plan(C.bill_cost_detail(*tables, few_rows(i["product"])))
        assert p.count("Exchange hashpartitioning(statement_id") == 2  # bills, lines
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_statement_buckets_follow_the_rows(spark, tmp_path, monkeypatch):
    """With four times the rows there are more buckets, none fuller: no task of the joins gets
    more rows as the tables grow.  A bucket that is not split is one file."""
    import glob
    import uuid

    from pyspark.sql import functions as F

    from ledgerline.plans import cost as C
    from ledgerline.plans.inputs import fixture_inputs

    monkeypatch.setattr(C, "BUCKET_ROWS", 6000, raising=False)
    i = fixture_inputs(spark, "/root/testdata/sf0.001")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    fullest, counts = {}, {}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for copies in (4, 16):
            shift = spark.range(copies).select((F.col("id") * 1_000_000).alias("__shift"))
            grown = [
                i[n].crossJoin(F.broadcast(shift)).withColumn(key, F.col(key) + F.col("__shift")).drop("__shift")
                for n, key in (("bill", "statement_id"), ("bill_lines", "statement_id"), ("settlement", "business_id"))
            ]
            names = tuple(f"{n}_{uuid.uuid4().hex[:6]}" for n in ("b", "l", "s"))
            paths = tuple(str(tmp_path / n) for n in names)
            C.store_by_statement(*grown, names, paths=paths)
            tables = [spark.table(n) for n in names]
            out = C.bill_cost_detail(*tables, F.broadcast(i["product"]))
            assert "Exchange hashpartitioning" not in plan(out)
            counts[copies] = out.rdd.getNumPartitions()
            # the rows of the three tables that one bucket has
            rows = [t.groupBy(F.pmod(F.hash(k), F.lit(counts[copies])).alias("bucket")).count()
                    for t, k in zip(tables, ("statement_id", "statement_id", "business_id"), strict=True)]
            total = rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("bucket").agg(F.sum("count").alias("n"))
            fullest[copies] = total.agg(F.max("n")).first()[0]
            assert all(len(glob.glob(f"{p}/part-*")) <= counts[copies] for p in paths)
            cost = lambda df: sorted(map(tuple, df.select("statement_id", "flow", "pay_channel", "cost_partner", "cost_channel").collect()), key=repr)
            assert cost(out) == cost(C.bill_cost_detail(*grown, i["product"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if before is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert counts[16] >= 3 * counts[4] > C.LEAST_BUCKETS
    assert max(fullest.values()) <= 1.5 * C.BUCKET_ROWS


def test_colocated_query_leaves_the_buckets_to_the_rows(spark, sf, monkeypatch):
    from ledgerline.plans import cost as C

    monkeypatch.setattr(C, "BUCKET_ROWS", 10_000, raising=False)
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in limits}
    try:
        for k in limits:
            spark.conf.set(k, "-1")
        buckets = QUERIES["cost_detail_colocated"](spark, sf).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert buckets >= 2 * rows // 10_000  # lines and settlements have a row for each
