"""Rule tables as data: lookups equal the expression-based rules, with or
without Spark's broadcast, and never multiply rows."""

from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.functions.geo import PROVINCE_BY_PREFIX, province
from ledgerline.operators.lookup import equality_rule, prefix_rule, rules_frame
from ledgerline.sources import fixtures as fx


def _rows(df, cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


def test_prefix_rule_table_equals_province_expression(spark, sf):
    ledger = fx.fx_ledger(spark, "/root/testdata/sf0.001").select("obu_id", "price")
    rules = rules_frame(spark, PROVINCE_BY_PREFIX, "prefix", "province")
    want = _rows(ledger.withColumn("province", province(F.col("obu_id"))), ["obu_id", "price", "province"])
    for limit in ("10MB", "-1"):  # broadcast by Spark's estimate, and shuffled
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = prefix_rule(ledger, "obu_id", 2, rules, "province", default=L.OTHER)
        assert _rows(got, ["obu_id", "price", "province"]) == want
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_equality_rule_duplicates_do_not_fan_out(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    rules = spark.createDataFrame([("a", "x"), ("a", "w"), ("b", "y")], "k string, label string")
    got = _rows(equality_rule(df, rules, ["k"], "label", default="none"), ["k", "v", "label"])
    assert got == sorted([("a", 1, "w"), ("b", 2, "y"), (None, 3, "none")], key=repr)


def test_rate_table_equals_the_single_cut_rule(spark):
    from datetime import date

    from ledgerline.functions.rules import effective_rate
    from ledgerline.operators.lookup import rate_from_table

    bills = spark.createDataFrame(
        [(1, date(1998, 12, 31)), (1, date(1999, 1, 1)), (2, date(2000, 5, 5)), (3, date(2000, 1, 1)), (None, date(2000, 1, 1))],
        "product_id bigint, bill_date date")
    products = spark.createDataFrame([(1, 0.1, 0.2), (2, 0.3, 0.4)], "product_id bigint, old double, new double")
    cut = date(1999, 1, 1)
    rates = products.selectExpr("product_id AS key", "DATE '1900-01-01' AS valid_from", f"DATE '{cut}' AS valid_to",
                                "old AS rate").unionByName(
        products.selectExpr("product_id AS key", f"DATE '{cut}' AS valid_from", "CAST(NULL AS DATE) AS valid_to",
                            "new AS rate"))
    want = (bills.join(products, "product_id", "left")
            .select("product_id", "bill_date", effective_rate(F.col("bill_date"), cut, F.col("old"), F.col("new")).alias("rate")))
    for limit in ("10MB", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        got = rate_from_table(bills, rates, "product_id", "bill_date", "rate")
        assert _rows(got, ["product_id", "bill_date", "rate"]) == _rows(want, ["product_id", "bill_date", "rate"])
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rate_versions_are_searched_by_date_and_overlaps_raise(spark):
    from datetime import date

    import pytest

    from ledgerline.operators.lookup import rate_from_table

    d = date
    schema = "key string, valid_from date, valid_to date, rate double"
    versions = [("a", d(2000, 1, 1), d(2000, 2, 1), 1.0), ("a", d(2000, 2, 1), d(2000, 3, 1), 2.0), ("a", d(2000, 6, 1), None, 3.0),
                ("b", None, d(2000, 1, 1), 9.0), ("b", d(2000, 5, 1), d(2000, 4, 1), 9.0), ("b", d(2000, 1, 1), None, 4.0), (None, d(2000, 1, 1), None, 5.0)]
    days = [d(1999, 12, 31), d(2000, 1, 1), d(2000, 1, 31), d(2000, 2, 1), d(2000, 3, 1), d(2000, 5, 31), d(2000, 6, 1), d(2010, 1, 1), None]
    rows = [(k, day, i) for i, k in enumerate(("a", "b", "c", None)) for day in days]
    df = spark.createDataFrame(rows, "k string, day date, n int")
    want = {("a", day): r for day, r in zip(days, (None, 1.0, 1.0, 2.0, None, None, 3.0, 3.0, None))}
    want |= {("b", day): 4.0 if day and day >= d(2000, 1, 1) else None for day in days}
    got = rate_from_table(df, spark.createDataFrame(versions, schema), "k", "day", "rate")
    assert {(r["k"], r["day"]): r["rate"] for r in got.collect()} == {(k, day): want.get((k, day)) for k, day, _ in rows}
    assert got.count() == len(rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "valid_from" not in "".join(line for line in plan.split("\n") if "Join" in line)
    for extra in (("a", d(2000, 1, 15), d(2000, 1, 20), 7.0), ("a", d(2000, 1, 1), d(2000, 2, 1), 1.0), ("b", d(2001, 1, 1), None, 7.0)):
        bad = spark.createDataFrame([*versions, extra], schema)
        with pytest.raises(Exception, match=f"overlapping rate versions of key {extra[0]}"):
            rate_from_table(df, bad, "k", "day", "rate").collect()
