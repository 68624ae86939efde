"""Portable fixture views over the driver tables.

The modelled jobs read warehouse tables (daily snapshots, service details,
bills, settlements) that do not exist in the test data.  Each fixture derives
one such table from the TPC-H-like tables, whole, with no row subset: its size
grows with the input.  Every fixture exists twice:

* a DataFrame builder (used by the Spark queries), and
* an SQL text (used by the DuckDB oracle), written independently.

Both must give the same rows and column names.  The Spark side uses
``explode`` where the SQL side joins to a tiny VALUES list, so no
nested-loop join appears in Spark plans.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources.tables import load_table

# fixed values: snapshot days of fx_snapshot (three month closes, one mid-month
# day, one more close)
SNAPSHOT_DAYS = [date(2001, 5, 1), date(2001, 6, 1), date(2001, 7, 1), date(2001, 7, 15), date(2001, 8, 1)]

# fixed values: device-id prefix by (part key mod 17); 15 and 16 fall outside
# the province table
DEVICE_PREFIX = ["44", "45", "13", "37", "15", "86", "65", "53", "40", "20", "19", "36", "33", "51", "22", "99", "99"]

# fixed values: ledger price by line quantity (quantities 16+ -> 180)
LEDGER_PRICE = {1: 80, 2: -80, 3: 70, 4: -70, 5: 150, 6: -150, 7: 130, 8: -130, 9: 195, 10: -195,
                11: 210, 12: -210, 13: -180, 14: 100, 15: None}


def case_map(col: Column, mapping: dict, default=None) -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END`` as a Column."""
    out = None
    for k, v in mapping.items():
        value = F.lit(v)
        out = F.when(col == k, value) if out is None else out.when(col == k, value)
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def device_id(partkey: Column) -> Column:
    prefix = F.element_at(F.array(*[F.lit(p) for p in DEVICE_PREFIX]), (partkey % 17 + 1).cast("int"))
    return F.concat(prefix, F.lpad(partkey.cast("string"), 8, "0"))


def _device_id_sql(expr: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(DEVICE_PREFIX))
    return f"(CASE {expr} % 17 {whens} END || lpad(CAST({expr} AS VARCHAR), 8, '0'))"


# --------------------------------------------------------------------------- fx_snapshot
def fx_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Daily full copies of an order-like business table, partition key ``ds``.

    Every order appears in every snapshot taken on or after its event day.
    Keys divisible by 7 are stored twice (true duplicates); keys divisible by
    10 restate their price in every snapshot (proves the right ds is read).
    """
    o = load_table(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    days = F.array(*[F.lit(d) for d in SNAPSHOT_DAYS])
    x = o.select(
        key, cust, "o_orderdate", "o_orderpriority",
        F.explode(F.sequence(F.lit(1), F.when(key % 7 == 0, 2).otherwise(1))).alias("copy"),
    ).select(
        "*", F.explode(F.filter(days, lambda d: d >= F.to_date("o_orderdate"))).alias("ds_date")
    )
    base_price = case_map(cust % 5, {0: 80, 1: 70, 2: 180, 3: -180}, 195)
    restated = F.when(key % 10 == 0, F.month("ds_date")).otherwise(0)
    return x.select(
        key.cast("string").alias("id"),
        cust.alias("vehicle_id"),
        F.col("o_orderdate").alias("event_ts"),
        (base_price + restated).cast("bigint").alias("price"),
        F.when(cust % 3 == 0, "bank_a").otherwise("bank_b").alias("bank"),
        case_map(key % 4, {0: "decrease", 1: "increase", 2: "offline"}).alias("remark"),
        F.when(key % 9 == 0, F.lit(None)).otherwise((key + 1000000).cast("string")).alias("provider_id"),
        F.when(key % 5 == 0, (key + 3000000).cast("string")).alias("new_obu_id"),
        case_map(cust % 4, {0: "preinstalled", 1: "not_preinstalled"}).alias("preinstall"),
        F.when(cust % 13 == 0, F.lit(None)).when(cust % 13 == 1, "x test y").otherwise("agent").alias("agent"),
        F.col("o_orderpriority").alias("dept"),
        (F.col("o_orderdate") - F.make_interval(days=(cust % 120).cast("int"))).alias("sign_time"),
        F.date_format("ds_date", "yyyyMMdd").alias("ds"),
    )


FX_SNAPSHOT_SQL = """
SELECT CAST(o.o_orderkey AS VARCHAR) AS id, o.o_custkey AS vehicle_id, o.o_orderdate AS event_ts,
       CAST(CASE o.o_custkey % 5 WHEN 0 THEN 80 WHEN 1 THEN 70 WHEN 2 THEN 180 WHEN 3 THEN -180 ELSE 195 END
            + CASE WHEN o.o_orderkey % 10 = 0 THEN month(cal.ds_date) ELSE 0 END AS BIGINT) AS price,
       CASE WHEN o.o_custkey % 3 = 0 THEN 'bank_a' ELSE 'bank_b' END AS bank,
       CASE o.o_orderkey % 4 WHEN 0 THEN 'decrease' WHEN 1 THEN 'increase' WHEN 2 THEN 'offline' END AS remark,
       CASE WHEN o.o_orderkey % 9 = 0 THEN NULL ELSE CAST(o.o_orderkey + 1000000 AS VARCHAR) END AS provider_id,
       CASE WHEN o.o_orderkey % 5 = 0 THEN CAST(o.o_orderkey + 3000000 AS VARCHAR) END AS new_obu_id,
       CASE o.o_custkey % 4 WHEN 0 THEN 'preinstalled' WHEN 1 THEN 'not_preinstalled' END AS preinstall,
       CASE WHEN o.o_custkey % 13 = 0 THEN NULL WHEN o.o_custkey % 13 = 1 THEN 'x test y' ELSE 'agent' END AS agent,
       o.o_orderpriority AS dept, o.o_orderdate - to_days(CAST(o.o_custkey % 120 AS INTEGER)) AS sign_time, strftime(cal.ds_date, '%Y%m%d') AS ds
FROM orders o
JOIN (VALUES (1), (2)) AS d(n) ON d.n = 1 OR o.o_orderkey % 7 = 0
JOIN (VALUES (DATE '2001-05-01'), (DATE '2001-06-01'), (DATE '2001-07-01'), (DATE '2001-07-15'), (DATE '2001-08-01'))
     AS cal(ds_date) ON CAST(o.o_orderdate AS DATE) <= cal.ds_date
"""


# --------------------------------------------------------------------------- fx_after_sales
def fx_after_sales(spark: SparkSession, root: str) -> DataFrame:
    """Daily full copies of the after-sales table: the snapshot's columns over other
    days, ids, prices and remarks.  Keys divisible by 11 are stored twice; keys
    divisible by 6 restate their price in every snapshot."""
    o = load_table(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    at = F.col("o_orderdate") + F.make_interval(days=F.lit(3))
    days = F.array(*[F.lit(d) for d in SNAPSHOT_DAYS])
    x = o.select(
        key, cust, at.alias("at"), "o_orderpriority",
        F.explode(F.sequence(F.lit(1), F.when(key % 11 == 0, 2).otherwise(1))).alias("copy"),
    ).select("*", F.explode(F.filter(days, lambda d: d >= F.to_date("at"))).alias("ds_date"))
    restated = F.when(key % 6 == 0, F.month("ds_date")).otherwise(0)
    return x.select(
        (key + 7000000).cast("string").alias("id"),
        (cust + 1).alias("vehicle_id"),
        F.col("at").alias("event_ts"),
        (case_map(cust % 4, {0: 180, 1: -180, 2: 60}, 120) + restated).cast("bigint").alias("price"),
        F.when(cust % 2 == 0, "bank_a").otherwise("bank_c").alias("bank"),
        case_map(key % 3, {0: "offline", 1: "decrease"}).alias("remark"),
        F.when(key % 8 == 0, F.lit(None)).otherwise((key + 8000000).cast("string")).alias("provider_id"),
        F.when(key % 3 == 0, (key + 9000000).cast("string")).alias("new_obu_id"),
        case_map(cust % 3, {0: "preinstalled", 1: "not_preinstalled"}).alias("preinstall"),
        F.when(cust % 7 == 0, F.lit(None)).otherwise("service").alias("agent"),
        F.col("o_orderpriority").alias("dept"),
        F.col("at").alias("sign_time"),
        F.date_format("ds_date", "yyyyMMdd").alias("ds"),
    )


FX_AFTER_SALES_SQL = """
SELECT CAST(o.o_orderkey + 7000000 AS VARCHAR) AS id, o.o_custkey + 1 AS vehicle_id, o.o_orderdate + INTERVAL 3 DAY AS event_ts,
       CAST(CASE o.o_custkey % 4 WHEN 0 THEN 180 WHEN 1 THEN -180 WHEN 2 THEN 60 ELSE 120 END
            + CASE WHEN o.o_orderkey % 6 = 0 THEN month(cal.ds_date) ELSE 0 END AS BIGINT) AS price,
       CASE WHEN o.o_custkey % 2 = 0 THEN 'bank_a' ELSE 'bank_c' END AS bank,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'offline' WHEN 1 THEN 'decrease' END AS remark,
       CASE WHEN o.o_orderkey % 8 = 0 THEN NULL ELSE CAST(o.o_orderkey + 8000000 AS VARCHAR) END AS provider_id,
       CASE WHEN o.o_orderkey % 3 = 0 THEN CAST(o.o_orderkey + 9000000 AS VARCHAR) END AS new_obu_id,
       CASE o.o_custkey % 3 WHEN 0 THEN 'preinstalled' WHEN 1 THEN 'not_preinstalled' END AS preinstall,
       CASE WHEN o.o_custkey % 7 = 0 THEN NULL ELSE 'service' END AS agent,
       o.o_orderpriority AS dept, o.o_orderdate + INTERVAL 3 DAY AS sign_time, strftime(cal.ds_date, '%Y%m%d') AS ds
FROM orders o
JOIN (VALUES (1), (2)) AS d(n) ON d.n = 1 OR o.o_orderkey % 11 = 0
JOIN (VALUES (DATE '2001-05-01'), (DATE '2001-06-01'), (DATE '2001-07-01'), (DATE '2001-07-15'), (DATE '2001-08-01'))
     AS cal(ds_date) ON CAST(o.o_orderdate + INTERVAL 3 DAY AS DATE) <= cal.ds_date
"""


# --------------------------------------------------------------------------- fx_live_adjustments
def fx_live_adjustments(spark: SparkSession, root: str) -> DataFrame:
    """Hand-loaded decreases of the live channel: day, service, money, device; all rows count."""
    li = load_table(spark, root, "lineitem")
    return li.select(
        F.to_date("l_shipdate").alias("date"),
        case_map(F.col("l_linenumber") % 4, {0: "new_paid", 1: "prepaid", 2: "signing"}, "waiver").alias("scene"),
        (-F.col("l_quantity")).cast("bigint").alias("money"), device_id(F.col("l_partkey")).alias("obu_id"),
    )


FX_LIVE_ADJUSTMENTS_SQL = f"""
SELECT CAST(l_shipdate AS DATE) AS date,
       CASE l_linenumber % 4 WHEN 0 THEN 'new_paid' WHEN 1 THEN 'prepaid' WHEN 2 THEN 'signing' ELSE 'waiver' END AS scene,
       CAST(0 - l_quantity AS BIGINT) AS money, {_device_id_sql('l_partkey')} AS obu_id
FROM lineitem
"""


# --------------------------------------------------------------------------- fx_ledger
def fx_ledger(spark: SparkSession, root: str) -> DataFrame:
    """A ledger-shaped table (one row per line item)."""
    li = load_table(spark, root, "lineitem")
    ln = F.col("l_linenumber")
    d = F.to_date("l_shipdate")
    return li.select(
        d.alias("date"),
        case_map(F.col("l_returnflag"), {"A": "signing", "N": "new_paid"}, "prepaid").alias("scene"),
        case_map(F.col("l_partkey") % 3, {0: "bank_a", 1: "bank_b"}, "person").alias("buyer"),
        case_map(F.col("l_quantity"), LEDGER_PRICE, 180).cast("bigint").alias("price"),
        case_map(F.col("l_suppkey") % 3, {0: "preinstalled", 1: "not_preinstalled"}).alias("preinstall"),
        F.when(F.col("l_suppkey") % 50 == 0, F.lit(None)).otherwise(device_id(F.col("l_partkey"))).alias("obu_id"),
        F.when(ln == 7, "adjustment").otherwise("receivable").alias("data_type"),
        F.when(ln == 7, "decrease").otherwise("receivable").alias("adjust_type"),
        F.when(F.col("l_linestatus") == "F", "truck").otherwise("bus").alias("segment"),
        case_map(ln, {1: "all_devices", 2: "waiver", 3: "signing_active", 4: "cancellation"}, "other").alias("scene2"),
        F.date_format(d, "yyyy-MM").alias("month"),
    )


_PRICE_WHENS = " ".join(f"WHEN {k} THEN {'NULL' if v is None else v}" for k, v in LEDGER_PRICE.items())
FX_LEDGER_SQL = f"""
SELECT CAST(l_shipdate AS DATE) AS date,
       CASE l_returnflag WHEN 'A' THEN 'signing' WHEN 'N' THEN 'new_paid' ELSE 'prepaid' END AS scene,
       CASE l_partkey % 3 WHEN 0 THEN 'bank_a' WHEN 1 THEN 'bank_b' ELSE 'person' END AS buyer,
       CAST(CASE l_quantity {_PRICE_WHENS} ELSE 180 END AS BIGINT) AS price,
       CASE l_suppkey % 3 WHEN 0 THEN 'preinstalled' WHEN 1 THEN 'not_preinstalled' END AS preinstall,
       CASE WHEN l_suppkey % 50 = 0 THEN NULL ELSE {_device_id_sql('l_partkey')} END AS obu_id,
       CASE WHEN l_linenumber = 7 THEN 'adjustment' ELSE 'receivable' END AS data_type,
       CASE WHEN l_linenumber = 7 THEN 'decrease' ELSE 'receivable' END AS adjust_type,
       CASE l_linestatus WHEN 'F' THEN 'truck' ELSE 'bus' END AS segment,
       CASE l_linenumber WHEN 1 THEN 'all_devices' WHEN 2 THEN 'waiver' WHEN 3 THEN 'signing_active'
            WHEN 4 THEN 'cancellation' ELSE 'other' END AS scene2,
       strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS month
FROM lineitem
"""


# --------------------------------------------------------------------------- fx_detail
DETAIL_DAYS = ["20010801", "20010701", "20010601"]


def fx_detail(spark: SparkSession, root: str) -> DataFrame:
    """Service detail snapshots of three days: receivable/received times and amounts.

    Keys divisible by 8 appear twice with another id and otherwise equal
    values, so merging of equal refunds shows.  Older snapshots hold other
    amounts, so reading the wrong day shows.
    """
    o = load_table(spark, root, "orders")
    key, cust, od = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    days = F.array(*[F.struct(F.lit(d).alias("ds"), F.lit(i).alias("age")) for i, d in enumerate(DETAIL_DAYS)])
    x = o.select(
        key, cust, od, "o_orderstatus",
        F.explode(F.sequence(F.lit(1), F.when(key % 8 == 0, 2).otherwise(1))).alias("n"),
    ).select("*", F.explode(days).alias("snap"))
    age = F.col("snap.age")
    null = F.lit(None)
    return x.select(
        (key + (F.col("n") - 1) * 10000000).cast("string").alias("id"),
        F.when(key % 19 == 0, null.cast("string")).when(key % 23 == 0, F.lit(" ")).otherwise(cust.cast("string")).alias("obu_id"),
        case_map(cust % 4, {0: "etc", 1: "data", 2: "live"}).alias("sale_department"),
        case_map(key % 3, {0: "replace", 1: "cancel"}, "new").alias("service_scene"),
        case_map(key % 7, {0: "replace", 1: "cancel", 2: "new", 3: "rebind_refund", 4: "upgrade", 5: "penalty"}).alias("service_scene2"),
        F.when(F.col("o_orderstatus") == "P", "refund").otherwise("collect").alias("service_type"),
        F.when(key % 11 == 0, null).otherwise(od).alias("obu_should_time"),
        od.alias("card_should_time"),
        F.when(key % 13 == 0, null).otherwise(od).alias("should_refund_time"),
        F.when(key % 5 == 0, null).otherwise(od).alias("actual_time"),
        F.when(key % 6 == 0, F.lit(0)).when(key % 17 == 0, null).otherwise(cust % 200 + age).cast("bigint").alias("should_amount"),
        (cust % 150 + age * 10).cast("bigint").alias("actual_amount"),
        case_map(cust % 6, {0: "excluded_channel", 1: "open_a", 2: "open_b"}).alias("openname"),
        F.when(key % 29 == 0, F.lit("stock")).alias("stock_type"),
        F.when(key % 31 == 0, null.cast("string")).otherwise(F.concat(F.lit("S"), key.cast("string"))).alias("service_order_id"),
        F.col("snap.ds").alias("ds"),
    )


FX_DETAIL_SQL = """
SELECT CAST(o_orderkey + (d.n - 1) * 10000000 AS VARCHAR) AS id,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS obu_id,
       CASE o_custkey % 4 WHEN 0 THEN 'etc' WHEN 1 THEN 'data' WHEN 2 THEN 'live' END AS sale_department,
       CASE o_orderkey % 3 WHEN 0 THEN 'replace' WHEN 1 THEN 'cancel' ELSE 'new' END AS service_scene,
       CASE o_orderkey % 7 WHEN 0 THEN 'replace' WHEN 1 THEN 'cancel' WHEN 2 THEN 'new' WHEN 3 THEN 'rebind_refund'
            WHEN 4 THEN 'upgrade' WHEN 5 THEN 'penalty' END AS service_scene2,
       CASE o_orderstatus WHEN 'P' THEN 'refund' ELSE 'collect' END AS service_type,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS obu_should_time,
       o_orderdate AS card_should_time,
       CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderdate END AS should_refund_time,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate END AS actual_time,
       CAST(CASE WHEN o_orderkey % 6 = 0 THEN 0 WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey % 200 + snap.age END AS BIGINT) AS should_amount,
       CAST(o_custkey % 150 + snap.age * 10 AS BIGINT) AS actual_amount,
       CASE o_custkey % 6 WHEN 0 THEN 'excluded_channel' WHEN 1 THEN 'open_a' WHEN 2 THEN 'open_b' END AS openname,
       CASE WHEN o_orderkey % 29 = 0 THEN 'stock' END AS stock_type,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'S' || CAST(o_orderkey AS VARCHAR) END AS service_order_id,
       snap.ds AS ds
FROM orders JOIN (VALUES (1), (2)) AS d(n) ON d.n = 1 OR o_orderkey % 8 = 0
CROSS JOIN (VALUES ('20010801', 0), ('20010701', 1), ('20010601', 2)) AS snap(ds, age)
"""


# --------------------------------------------------------------------------- fx_manual_income
def fx_manual_income(spark: SparkSession, root: str) -> DataFrame:
    """Hand-loaded decreases of personal income, labelled by service."""
    o = load_table(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.to_date("o_orderdate").alias("date"), case_map(key % 4, {0: "new_paid", 1: "prepaid", 2: "signing"}).alias("scene2"),
        (-(cust % 90)).cast("bigint").alias("price"), device_id(cust).alias("obu_id"),
    )


FX_MANUAL_INCOME_SQL = f"""
SELECT CAST(o_orderdate AS DATE) AS date, CASE o_orderkey % 4 WHEN 0 THEN 'new_paid' WHEN 1 THEN 'prepaid' WHEN 2 THEN 'signing' END AS scene2,
       CAST(0 - o_custkey % 90 AS BIGINT) AS price, {_device_id_sql('o_custkey')} AS obu_id
FROM orders
"""


# --------------------------------------------------------------------------- fx_person_services
def fx_person_services(spark: SparkSession, root: str) -> DataFrame:
    """Hand-loaded half-year decreases of personal payments, labelled by service; a table
    of its own, with other days, amounts and devices than the manual income."""
    o = load_table(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.date_add(F.to_date("o_orderdate"), 9).alias("date"), case_map(key % 5, {0: "new_paid", 1: "prepaid", 2: "signing", 3: "waiver"}).alias("scene2"),
        (-(cust % 70) - 5).cast("bigint").alias("price"), device_id(cust + 3).alias("obu_id"),
    )


FX_PERSON_SERVICES_SQL = f"""
SELECT CAST(o_orderdate AS DATE) + 9 AS date,
       CASE o_orderkey % 5 WHEN 0 THEN 'new_paid' WHEN 1 THEN 'prepaid' WHEN 2 THEN 'signing' WHEN 3 THEN 'waiver' END AS scene2,
       CAST(-5 - o_custkey % 70 AS BIGINT) AS price, {_device_id_sql('(o_custkey + 3)')} AS obu_id
FROM orders
"""


# --------------------------------------------------------------------------- fx_person_scenes
def fx_person_scenes(spark: SparkSession, root: str) -> DataFrame:
    """Hand-loaded decreases of personal payments with the scene they belong to."""
    o = load_table(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        case_map(key % 3, {0: "new_paid", 1: "cancel_paid"}).alias("scene"), (-(cust % 70)).cast("bigint").alias("price"),
        device_id(cust).alias("obu_id"),
    )


FX_PERSON_SCENES_SQL = f"""
SELECT CASE o_orderkey % 3 WHEN 0 THEN 'new_paid' WHEN 1 THEN 'cancel_paid' END AS scene, CAST(0 - o_custkey % 70 AS BIGINT) AS price,
       {_device_id_sql('o_custkey')} AS obu_id
FROM orders
"""


# --------------------------------------------------------------------------- fx_loaded_corrections
def fx_loaded_corrections(spark: SparkSession, root: str) -> DataFrame:
    """Corrections shaped like the merged ledger; every fourth names the month before 2001-07."""
    o = load_table(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.to_date("o_orderdate").alias("date"), F.lit("signing").alias("scene"), F.lit("bank_c").alias("buyer"),
        (cust % 210).cast("bigint").alias("price"), F.lit("preinstalled").alias("preinstall"), device_id(cust).alias("obu_id"),
        F.lit("adjustment").alias("data_type"), F.lit("increase").alias("adjust_type"),
        F.when(key % 2 == 0, "truck").otherwise("bus").alias("segment"), F.lit("loaded_correction").alias("scene2"),
        F.lit(0).cast("decimal(18,6)").alias("net_price"),
        F.when(key % 4 == 0, "2001-06").otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("month"),
    )


FX_LOADED_CORRECTIONS_SQL = f"""
SELECT CAST(o_orderdate AS DATE) AS date, 'signing' AS scene, 'bank_c' AS buyer, CAST(o_custkey % 210 AS BIGINT) AS price,
       'preinstalled' AS preinstall, {_device_id_sql('o_custkey')} AS obu_id, 'adjustment' AS data_type, 'increase' AS adjust_type,
       CASE WHEN o_orderkey % 2 = 0 THEN 'truck' ELSE 'bus' END AS segment, 'loaded_correction' AS scene2,
       CAST(0 AS DECIMAL(18,6)) AS net_price,
       CASE WHEN o_orderkey % 4 = 0 THEN '2001-06' ELSE strftime(o_orderdate, '%Y-%m') END AS month
FROM orders
"""


# --------------------------------------------------------------------------- fx_other_adjustments
def fx_other_adjustments(spark: SparkSession, root: str) -> DataFrame:
    """Hand-loaded movement corrections, already shaped like D9's output."""
    o = load_table(spark, root, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.lit("etc").alias("sale_department"), F.lit("upgrade").alias("service_scene2"), F.col("o_orderdate").alias("date"),
        F.when(key % 31 == 0, F.lit(" ")).otherwise(cust.cast("string")).alias("obu_id"), (-(cust % 40)).cast("bigint").alias("price"),
        F.concat(F.lit("A"), key.cast("string")).alias("id"), F.lit("20010801").alias("ds"), F.lit("received").alias("scene"),
        F.lit("adjustment").alias("data_type"), F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )


FX_OTHER_ADJUSTMENTS_SQL = """
SELECT 'etc' AS sale_department, 'upgrade' AS service_scene2, o_orderdate AS date,
       CASE WHEN o_orderkey % 31 = 0 THEN ' ' ELSE CAST(o_custkey AS VARCHAR) END AS obu_id, CAST(0 - o_custkey % 40 AS BIGINT) AS price,
       'A' || o_orderkey AS id, '20010801' AS ds, 'received' AS scene, 'adjustment' AS data_type, strftime(o_orderdate, '%Y-%m') AS month
FROM orders
"""


# --------------------------------------------------------------------------- fx_equipment
def fx_equipment(spark: SparkSession, root: str) -> DataFrame:
    """Equipment payments (not a snapshot): pay/refund times and states."""
    o = load_table(spark, root, "orders")
    key, cust, od = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    return o.select(
        key.cast("string").alias("id"),
        F.when(key % 9 == 0, F.lit(None)).otherwise((cust + 2000000).cast("string")).alias("provider_id"),
        od.alias("gmt_payment"),
        F.when(key % 4 == 0, F.date_add(F.to_date(od), 20)).alias("gmt_refund"),
        F.when(F.col("o_orderstatus") == "P", "CLOSED").otherwise("SUCCESS").alias("pay_state"),
        F.when(key % 4 == 0, F.when(key % 8 == 0, "REFUND_SUCCESS").otherwise("REFUND_CLOSED")).alias("refund_state"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("equipment_amount"),
        case_map(cust % 3, {0: "card_swap", 1: "device_swap"}, "new").alias("category"),
        case_map(key % 5, {0: "data", 1: "etc", 2: "data", 3: "etc"}, "live").alias("department"),
        case_map(cust % 4, {0: "data", 1: "etc", 2: "data"}, "live").alias("sale_department"),
        case_map(key % 3, {0: "preinstalled", 1: "not_preinstalled"}).alias("preinstall"),
    )


FX_EQUIPMENT_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey + 2000000 AS VARCHAR) END AS provider_id,
       o_orderdate AS gmt_payment,
       CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) + 20 END AS gmt_refund,
       CASE WHEN o_orderstatus = 'P' THEN 'CLOSED' ELSE 'SUCCESS' END AS pay_state,
       CASE WHEN o_orderkey % 4 = 0 THEN CASE WHEN o_orderkey % 8 = 0 THEN 'REFUND_SUCCESS' ELSE 'REFUND_CLOSED' END END AS refund_state,
       CAST(o_totalprice AS DECIMAL(18,2)) AS equipment_amount,
       CASE o_custkey % 3 WHEN 0 THEN 'card_swap' WHEN 1 THEN 'device_swap' ELSE 'new' END AS category,
       CASE o_orderkey % 5 WHEN 0 THEN 'data' WHEN 1 THEN 'etc' WHEN 2 THEN 'data' WHEN 3 THEN 'etc' ELSE 'live' END AS department,
       CASE o_custkey % 4 WHEN 0 THEN 'data' WHEN 1 THEN 'etc' WHEN 2 THEN 'data' ELSE 'live' END AS sale_department,
       CASE o_orderkey % 3 WHEN 0 THEN 'preinstalled' WHEN 1 THEN 'not_preinstalled' END AS preinstall
FROM orders
"""


# --------------------------------------------------------------------------- fx_bill / fx_settlement / fx_product
def fx_bill(spark: SparkSession, root: str) -> DataFrame:
    """One bill per (statement, flow); money in DECIMAL so sums are exact."""
    li = load_table(spark, root, "lineitem")
    # min() over small numeric codes instead of strings keeps this a hash
    # aggregate (string min/max would force a sort-based aggregate)
    flag_code = case_map(F.col("l_returnflag"), {"A": 0, "N": 1}, 2)
    g = li.groupBy("l_orderkey", "l_linenumber").agg(
        F.min(F.to_date("l_shipdate")).alias("bill_date"),
        F.min("l_partkey").alias("product_id"),
        F.min(F.when(F.col("l_linestatus") == "F", 0).otherwise(1)).alias("_status"),
        F.min(flag_code).alias("_flag"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("bill_amount"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("service_fee"),
        F.sum(F.col("l_discount").cast("decimal(18,2)")).alias("_late"),
    )
    return g.select(
        F.col("l_orderkey").alias("statement_id"),
        F.col("l_linenumber").alias("flow"),
        "bill_date",
        "product_id",
        F.when(F.col("_status") == 0, "loan").otherwise("other").alias("loan_type"),
        case_map(F.col("_flag"), {0: "type_a", 1: "type_n"}).alias("big_bill_type"),
        "bill_amount",
        "service_fee",
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("_late")).alias("late_fee"),
        (F.col("l_orderkey") % 1000).alias("user_id"),
        case_map(F.col("l_linenumber") % 3, {0: "cleared", 1: "due"}, "open").alias("state"),
        (F.col("l_orderkey") * 3 + 1).alias("account_id"),
        F.date_format("bill_date", "yyyyMM").alias("period_id"),
        F.col("l_linenumber").alias("flow_level"),
        F.date_add("bill_date", 20).alias("last_due_date"),
        F.when(F.col("l_linenumber") % 3 == 0, F.date_add("bill_date", 5)).alias("cleared_date"),
        F.when(F.col("l_orderkey") % 4 != 0, F.concat_ws("-", F.lit("R"), F.col("l_orderkey"), F.col("l_linenumber"))).alias("repayment_id"),
        case_map(F.col("l_linenumber") % 2, {0: "toll"}, "service").alias("bill_type"),
        case_map(F.col("l_orderkey") % 2, {0: "credit"}, "debit").alias("big_type"),
        (F.col("bill_amount") + F.col("service_fee")).cast("decimal(18,2)").alias("total_amount"),
        F.when(F.col("l_linenumber") % 3 == 0, F.col("bill_amount")).otherwise(0).cast("decimal(18,2)").alias("repayment"),
        (F.col("bill_amount") - F.col("service_fee")).cast("decimal(18,2)").alias("actual_amount"),
        F.when(F.col("l_orderkey") % 5 != 0, F.concat(F.lit("C"), (F.col("l_orderkey") % 700).cast("string"))).alias("customer_id"),
        F.date_add("bill_date", -400).alias("open_date"),
        F.when(F.col("l_orderkey") % 10 == 0, "1").otherwise("0").alias("is_white"),
        case_map(F.col("l_orderkey") % 6, {0: "frozen", 1: "closed"}, "active").alias("cust_state"),
    )


FX_BILL_SQL = """
SELECT l_orderkey AS statement_id, l_linenumber AS flow, min(CAST(l_shipdate AS DATE)) AS bill_date,
       min(l_partkey) AS product_id,
       CASE min(l_linestatus) WHEN 'F' THEN 'loan' ELSE 'other' END AS loan_type,
       CASE min(l_returnflag) WHEN 'A' THEN 'type_a' WHEN 'N' THEN 'type_n' END AS big_bill_type,
       sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS bill_amount,
       sum(CAST(l_quantity AS DECIMAL(18,2))) AS service_fee,
       CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE sum(CAST(l_discount AS DECIMAL(18,2))) END AS late_fee,
       l_orderkey % 1000 AS user_id, CASE l_linenumber % 3 WHEN 0 THEN 'cleared' WHEN 1 THEN 'due' ELSE 'open' END AS state,
       l_orderkey * 3 + 1 AS account_id, strftime(min(CAST(l_shipdate AS DATE)), '%Y%m') AS period_id, l_linenumber AS flow_level,
       min(CAST(l_shipdate AS DATE)) + 20 AS last_due_date,
       CASE WHEN l_linenumber % 3 = 0 THEN min(CAST(l_shipdate AS DATE)) + 5 END AS cleared_date,
       CASE WHEN l_orderkey % 4 <> 0 THEN 'R-' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS repayment_id,
       CASE WHEN l_linenumber % 2 = 0 THEN 'toll' ELSE 'service' END AS bill_type,
       CASE WHEN l_orderkey % 2 = 0 THEN 'credit' ELSE 'debit' END AS big_type,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) + sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount,
       CAST(CASE WHEN l_linenumber % 3 = 0 THEN sum(CAST(l_extendedprice AS DECIMAL(18,2))) ELSE 0 END AS DECIMAL(18,2)) AS repayment,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) - sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS actual_amount,
       CASE WHEN l_orderkey % 5 <> 0 THEN 'C' || CAST(l_orderkey % 700 AS VARCHAR) END AS customer_id,
       min(CAST(l_shipdate AS DATE)) - 400 AS open_date, CASE WHEN l_orderkey % 10 = 0 THEN '1' ELSE '0' END AS is_white,
       CASE l_orderkey % 6 WHEN 0 THEN 'frozen' WHEN 1 THEN 'closed' ELSE 'active' END AS cust_state
FROM lineitem GROUP BY l_orderkey, l_linenumber
"""


def fx_settlement(spark: SparkSession, root: str) -> DataFrame:
    """Settlement splits, not pre-aggregated; several rows per business id."""
    li = load_table(spark, root, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("business_id"),
        case_map(F.col("l_returnflag"), {"A": "channel_bank", "R": "channel_wallet"}, "channel_other").alias("pay_channel"),
        F.col("l_quantity").cast("decimal(18,2)").alias("split_amount"),
    )


FX_SETTLEMENT_SQL = """
SELECT l_orderkey AS business_id,
       CASE l_returnflag WHEN 'A' THEN 'channel_bank' WHEN 'R' THEN 'channel_wallet' ELSE 'channel_other' END AS pay_channel,
       CAST(l_quantity AS DECIMAL(18,2)) AS split_amount
FROM lineitem
"""


def fx_product(spark: SparkSession, root: str) -> DataFrame:
    """Product cost dimension.  Parts whose key is divisible by 20 are filed
    under a negative id no bill uses, so the left join has unmatched rows."""
    p = load_table(spark, root, "part")
    k, size = F.col("p_partkey"), F.col("p_size").cast("decimal(9,4)")
    return p.select(
        F.when(k % 20 == 0, -k).otherwise(k).alias("product_id"),
        case_map(k % 3, {0: "0", 1: "1"}, "2").alias("part_flag"),
        F.when(F.col("p_size") % 2 == 0, "1").otherwise("0").alias("channel_flag"),
        (size / 1000).cast("decimal(9,6)").alias("part_rate_old"),
        (size / 500).cast("decimal(9,6)").alias("part_rate_new"),
        (size / 2000).cast("decimal(9,6)").alias("channel_rate"),
    )


FX_PRODUCT_SQL = """
SELECT CASE WHEN p_partkey % 20 = 0 THEN -p_partkey ELSE p_partkey END AS product_id,
       CASE p_partkey % 3 WHEN 0 THEN '0' WHEN 1 THEN '1' ELSE '2' END AS part_flag,
       CASE WHEN p_size % 2 = 0 THEN '1' ELSE '0' END AS channel_flag,
       CAST(CAST(p_size AS DECIMAL(9,4)) / 1000 AS DECIMAL(9,6)) AS part_rate_old,
       CAST(CAST(p_size AS DECIMAL(9,4)) / 500 AS DECIMAL(9,6)) AS part_rate_new,
       CAST(CAST(p_size AS DECIMAL(9,4)) / 2000 AS DECIMAL(9,6)) AS channel_rate
FROM part
"""


# --------------------------------------------------------------------------- bill-line key set
def fx_bill_lines(spark: SparkSession, root: str) -> DataFrame:
    li = load_table(spark, root, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("statement_id"),
        F.col("l_linenumber").alias("flow"),
        F.col("l_shipdate").alias("bill_time"),
        F.when(F.col("l_linestatus") == "F", "card_l").otherwise("card_o").alias("card_type"),
        F.date_format("l_shipdate", "yyyy-MM").alias("month"),
    )


FX_BILL_LINES_SQL = """
SELECT l_orderkey AS statement_id, l_linenumber AS flow, l_shipdate AS bill_time,
       CASE WHEN l_linestatus = 'F' THEN 'card_l' ELSE 'card_o' END AS card_type, strftime(l_shipdate, '%Y-%m') AS month
FROM lineitem
"""


# --------------------------------------------------------------------------- deposits
def fx_accounts(spark: SparkSession, root: str) -> DataFrame:
    c = load_table(spark, root, "customer")
    k = F.col("c_custkey")
    return c.select(
        F.concat(case_map(k % 3, {0: "BZ9", 1: "9"}, "5"), k.cast("string")).alias("accno"),
        F.when(k % 2 == 0, "bank_a").otherwise("bank_b").alias("bank_name"),
        F.round(F.col("c_acctbal") * 100).cast("bigint").alias("balance_cents"),
    )


FX_ACCOUNTS_SQL = """
SELECT CASE c_custkey % 3 WHEN 0 THEN 'BZ9' WHEN 1 THEN '9' ELSE '5' END || CAST(c_custkey AS VARCHAR) AS accno,
       CASE c_custkey % 2 WHEN 0 THEN 'bank_a' ELSE 'bank_b' END AS bank_name,
       CAST(round(c_acctbal * 100) AS BIGINT) AS balance_cents
FROM customer
"""


def fx_wallet(spark: SparkSession, root: str) -> DataFrame:
    s = load_table(spark, root, "supplier")
    return s.select(F.col("s_acctbal").cast("decimal(18,2)").alias("wallet_balance"))


FX_WALLET_SQL = "SELECT CAST(s_acctbal AS DECIMAL(18,2)) AS wallet_balance FROM supplier"


# --------------------------------------------------------------------------- enrichment sources
def fx_external_channel(spark: SparkSession, root: str) -> DataFrame:
    """Devices sold through an external channel (may repeat)."""
    li = load_table(spark, root, "lineitem")
    return li.where(F.col("l_returnflag") == "R").select(device_id(F.col("l_partkey")).alias("lasted_obu"))


FX_EXTERNAL_CHANNEL_SQL = f"SELECT {_device_id_sql('l_partkey')} AS lasted_obu FROM lineitem WHERE l_returnflag = 'R'"


def fx_shop_orders(spark: SparkSession, root: str) -> DataFrame:
    o = load_table(spark, root, "orders")
    return o.select(F.col("o_orderkey").alias("o_id"), F.col("o_custkey").alias("uuid"))


def fx_shop_serials(spark: SparkSession, root: str) -> DataFrame:
    li = load_table(spark, root, "lineitem")
    return li.select(F.col("l_orderkey").alias("o_id"), device_id(F.col("l_partkey")).alias("sn"))


def fx_shop_items(spark: SparkSession, root: str) -> DataFrame:
    c = load_table(spark, root, "customer")
    return c.where(F.col("c_mktsegment") == "AUTOMOBILE").select(F.col("c_custkey").alias("uuid"))


FX_SHOP_ORDERS_SQL = "SELECT o_orderkey AS o_id, o_custkey AS uuid FROM orders"
FX_SHOP_SERIALS_SQL = f"SELECT l_orderkey AS o_id, {_device_id_sql('l_partkey')} AS sn FROM lineitem"
FX_SHOP_ITEMS_SQL = "SELECT c_custkey AS uuid FROM customer WHERE c_mktsegment = 'AUTOMOBILE'"


def fx_device(spark: SparkSession, root: str) -> DataFrame:
    """Device dimension with several names per device (latest by max)."""
    li = load_table(spark, root, "lineitem")
    s = F.col("l_suppkey")
    name = F.when(s % 4 == 0, F.concat(F.lit("smart_etc_"), s.cast("string"))).otherwise(
        F.concat(F.lit("plain_"), s.cast("string")))
    return li.select(device_id(F.col("l_partkey")).alias("obuid"), name.alias("openname"))


FX_DEVICE_SQL = f"""
SELECT {_device_id_sql('l_partkey')} AS obuid,
       CASE WHEN l_suppkey % 4 = 0 THEN 'smart_etc_' || CAST(l_suppkey AS VARCHAR)
            ELSE 'plain_' || CAST(l_suppkey AS VARCHAR) END AS openname
FROM lineitem
"""


def fx_order_map(spark: SparkSession, root: str) -> DataFrame:
    """Service order id -> device id map for id resolution (may hold several rows per order)."""
    li = load_table(spark, root, "lineitem")
    return li.select(
        F.concat(F.lit("S"), F.col("l_orderkey").cast("string")).alias("order_id"), device_id(F.col("l_partkey")).alias("device_id"))


FX_ORDER_MAP_SQL = f"""
SELECT 'S' || CAST(l_orderkey AS VARCHAR) AS order_id, {_device_id_sql('l_partkey')} AS device_id
FROM lineitem
"""


def with_fixtures(sql_body: str, names: list[str], extra_ctes: str | None = None) -> str:
    """Prefix an oracle query with the fixture CTEs it uses (and extra CTEs)."""
    texts = {
        "fx_snapshot": FX_SNAPSHOT_SQL,
        "fx_after_sales": FX_AFTER_SALES_SQL,
        "fx_live_adjustments": FX_LIVE_ADJUSTMENTS_SQL,
        "fx_ledger": FX_LEDGER_SQL,
        "fx_detail": FX_DETAIL_SQL,
        "fx_equipment": FX_EQUIPMENT_SQL,
        "fx_bill": FX_BILL_SQL,
        "fx_settlement": FX_SETTLEMENT_SQL,
        "fx_product": FX_PRODUCT_SQL,
        "fx_bill_lines": FX_BILL_LINES_SQL,
        "fx_accounts": FX_ACCOUNTS_SQL,
        "fx_wallet": FX_WALLET_SQL,
        "fx_external_channel": FX_EXTERNAL_CHANNEL_SQL,
        "fx_shop_orders": FX_SHOP_ORDERS_SQL,
        "fx_shop_serials": FX_SHOP_SERIALS_SQL,
        "fx_shop_items": FX_SHOP_ITEMS_SQL,
        "fx_device": FX_DEVICE_SQL,
        "fx_order_map": FX_ORDER_MAP_SQL,
        "fx_corrections": FX_CORRECTIONS_SQL,
        "fx_adjust_file": FX_ADJUST_FILE_SQL,
        "fx_other_adjustments": FX_OTHER_ADJUSTMENTS_SQL,
        "fx_manual_income": FX_MANUAL_INCOME_SQL,
        "fx_person_services": FX_PERSON_SERVICES_SQL,
        "fx_person_scenes": FX_PERSON_SCENES_SQL,
        "fx_loaded_corrections": FX_LOADED_CORRECTIONS_SQL,
    }
    ctes = ",\n".join([f"{n} AS ({texts[n]})" for n in names] + ([extra_ctes] if extra_ctes else []))
    return f"WITH {ctes}\n{sql_body}"


# --------------------------------------------------------------------------- merge inputs
def fx_corrections(spark: SparkSession, root: str) -> DataFrame:
    """Ledger-shaped correction table (with net price): reverses adjustment rows.  Those of
    bank_b in and after 2001-07 correct the month 2001-05, which is older than their date."""
    lg = fx_ledger(spark, root)
    late = (F.col("buyer") == "bank_b") & (F.col("month") >= "2001-07")
    return lg.where(F.col("data_type") == "adjustment").select(
        "date", "scene", "buyer", (-F.col("price")).alias("price"), "preinstall", "obu_id", "data_type",
        F.lit("increase").alias("adjust_type"), "segment", F.lit("quarter_correction").alias("scene2"),
        F.lit(0).cast("decimal(18,6)").alias("net_price"), F.when(late, "2001-05").otherwise(F.col("month")).alias("month"),
    )


FX_CORRECTIONS_SQL = """
SELECT date, scene, buyer, 0 - price AS price, preinstall, obu_id, data_type, 'increase' AS adjust_type, segment,
       'quarter_correction' AS scene2, CAST(0 AS DECIMAL(18,6)) AS net_price,
       CASE WHEN buyer = 'bank_b' AND month >= '2001-07' THEN '2001-05' ELSE month END AS month
FROM fx_ledger WHERE data_type = 'adjustment'
"""


def fx_adjust_file(spark: SparkSession, root: str) -> DataFrame:
    """Adjustment file needing label mapping: device, signed amount, month."""
    lg = fx_ledger(spark, root)
    return lg.where((F.col("scene2") == "cancellation") & (F.col("segment") == "bus")).select(
        "obu_id", "price", "month")


FX_ADJUST_FILE_SQL = "SELECT obu_id, price, month FROM fx_ledger WHERE scene2 = 'cancellation' AND segment = 'bus'"
