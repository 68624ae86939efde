"""Skew: a third of the rows share a NULL key, another third one hot device.
Results must equal a brute-force computation; NULL keys are spread."""

from collections import Counter
from datetime import date

from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.plans import reports as R

HOT = "4400000042"


def _ledger(spark, n=3000):
    rows = []
    for i in range(n):
        key = None if i % 3 == 0 else (HOT if i % 3 == 1 else f"45{i:08d}")
        scene2 = "waiver" if i % 5 == 0 else "all_devices"
        buyer = "bank_a" if i % 2 else "bank_b"
        rows.append((date(2001, 7, 1 + i % 28), L.SIGNING, buyer, 80, None, key, L.RECEIVABLE, L.RECEIVABLE,
                     L.TRUCK, scene2, "2001-07"))
    schema = ("date date, scene string, buyer string, price int, preinstall string, obu_id string, data_type string, "
              "adjust_type string, segment string, scene2 string, month string")
    return rows, spark.createDataFrame(rows, schema).repartition(8)


def test_waiver_summary_under_skew_matches_brute_force(spark):
    rows, df = _ledger(spark)
    got = {(r["date"], r["province"], r["buyer"], r["mark"]): r["amt"] for r in R.waiver_summary(df).collect()}
    devices = {(r[0], r[5], r[2]) for r in rows if r[9] == "all_devices"}
    waived = {(r[5], r[2]) for r in rows if r[9] == "waiver" and r[5] is not None}
    prov = {"44": "Guangdong", "45": "Guangxi"}
    want = Counter()
    zero = Counter()
    for d, key, buyer in devices:
        p = prov.get((key or "")[:2], L.OTHER)
        mark = L.YES if key is not None and (key, buyer) in waived else L.NO
        if key is None:
            zero[(d, p, buyer, mark)] += 0
        else:
            want[(d, p, buyer, mark)] += 1
    expected = {**{k: 0 for k in zero}, **dict(want)}
    assert got == expected


def test_null_keys_are_spread_not_clustered(spark):
    rows, df = _ledger(spark)
    devices = spark.createDataFrame([(HOT, "x")], "obuid string, openname string")
    out = R.latest_name(df, devices)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "xxhash64" in plan
    assert out.count() == len(rows)
    assert out.where(F.col("obu_id").isNull()).count() == len(rows) // 3
    assert out.where(F.col("openname") == "x").count() == len(rows) // 3


def test_aqe_splits_a_hot_key(spark):
    """With a third of the rows on one key, the final plans of the joins on unique
    right sides split the hot partition."""
    import pytest

    from ledgerline.operators.joins import attach_dimensions, attach_one_per_key, flag_existence, resolve_id

    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in limits}
    left = spark.range(300_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20_000)).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    right = spark.range(40_000).select(F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20_000)).alias("k"), F.col("id").cast("string").alias("w"))
    cases = {
        "flag_existence": lambda: flag_existence(left, right, ["key"], ["k"], "mark"),
        "attach_one_per_key": lambda: attach_one_per_key(left, right, "key", "k", {"w": F.max("w")}),
        "resolve_id": lambda: resolve_id(left, right, "key", "k", "w", unique=True),
        "attach_dimensions": lambda: attach_dimensions(left, "key", [(right, "k", {"is_in": None}), (right, "k", {"w": F.max("w")})]),
    }
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        for name, build in cases.items():
            out = build()
            out.write.format("noop").mode("overwrite").save()
            rows = out.collect()
            assert len(rows) == 300_000, name
            plan = out._jdf.queryExecution().executedPlan().toString()
            if "skew=true" not in plan:
                pytest.fail(f"{name}: hot key not split")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_statement_is_taken_out_of_the_settlement_join(spark):
    """A third of the bills and of the settlements on one statement: found by the sketch,
    joined by broadcast, dealt by flow; results equal those without the split."""
    from datetime import date as day
    from decimal import Decimal

    from ledgerline.operators.joins import hot_keys
    from ledgerline.plans import cost as C

    n = 6000
    statement = lambda i: 7 if i % 3 == 0 else 100 + i
    bill = spark.createDataFrame(
        [(statement(i), i, day(1998, 3, 1 + i % 9), i % 5, "loan" if i % 2 else "other", "type_a", Decimal(10 + i % 7), Decimal(3), None) for i in range(n)],
        "statement_id long, flow int, bill_date date, product_id int, loan_type string, big_bill_type string, bill_amount decimal(18,2), service_fee decimal(18,2), late_fee decimal(18,2)")
    lines = bill.select("statement_id", "flow", F.lit("1998-02-01 00:00:00").cast("timestamp_ntz").alias("bill_time"),
                        F.when(F.col("flow") % 4 != 3, C.BILL_CARD_TYPE).otherwise("x").alias("card_type"), F.lit("1998-02").alias("month"))
    paid = spark.createDataFrame([(statement(i), ("channel_bank", "channel_wallet", "channel_other")[i // 3 % 3], Decimal(1 + i % 11)) for i in range(n)],
                                 "business_id long, pay_channel string, split_amount decimal(18,2)")
    product = spark.createDataFrame([(i, str(i % 3), str(i % 2), Decimal("0.01"), Decimal("0.02"), Decimal("0.03")) for i in range(4)],
                                    "product_id int, part_flag string, channel_flag string, part_rate_old decimal(9,6), part_rate_new decimal(9,6), channel_rate decimal(9,6)")
    hot = hot_keys(bill, "statement_id", least=1000)
    assert hot == [7] and hot_keys(bill, "statement_id", least=n) == [] and hot_keys(bill.limit(0), "statement_id") == []
    for pivot in (False, True):
        split = C.bill_cost_detail(bill, lines, paid, product, pivot=pivot, hot=hot)
        whole = C.bill_cost_detail(bill, lines, paid, product, pivot=pivot)
        rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
        assert rows(split) == rows(whole)
        assert split.where("statement_id = 7").count() >= n // 4
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            p = split._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        # the hot statement's bills are dealt by flow too, its sums broadcast, its settlements by salt
        assert "Exchange hashpartitioning(statement_id" in p and "flow" in p
        assert "__salt" in p and "BroadcastExchange" in p
        largest = bill.where("statement_id = 7").repartition(8, "statement_id", "flow").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        assert largest < n // 3 / 4
