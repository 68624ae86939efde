"""Reports refreshed per month equal the full refresh, and read no other partition."""

import uuid
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline import sinks as K
from ledgerline.plans import reports as R
from ledgerline.plans import summaries as S
from ledgerline.session import scratch_path

COLUMNS = ("date date, scene string, buyer string, price decimal(18,2), preinstall string, obu_id string, data_type string, "
           "adjust_type string, segment string, scene2 string, net_price decimal(18,6), month string")


def _rows(n, month, seed=0):
    out = []
    for i in range(n):
        k = i * 7 + seed
        segment = L.TRUCK if k % 3 else L.BUS
        scene2 = ("all_devices", "waiver", "other")[k % 4 % 3]
        obu = None if k % 17 == 0 else f"{(44, 45, 99)[k % 3]}{k % 23:08d}"
        out.append((date(2001, month, 1 + i % 27), (L.SIGNING, L.NEW_PAID)[k % 2], ("bank_a", "bank_b")[k % 5 % 2], Decimal(10 * (k % 4)), None, obu,
                    L.RECEIVABLE, L.RECEIVABLE, segment, scene2, Decimal(0), f"2001-{month:02d}"))
    return out


def _same(spark, tables, ledger, members, device):
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    plain = R.enrich(ledger, members, device)
    assert rows(spark.table(tables.enriched).select(*plain.columns)) == rows(plain)
    assert rows(spark.table(tables.summary)) == rows(R.ledger_summary(plain).select(*spark.table(tables.summary).columns))
    assert rows(spark.table(tables.waiver)) == rows(R.waiver_summary(ledger))


def test_incremental_days_equal_the_full_refresh(spark):
    tag = uuid.uuid4().hex[:6]
    name = f"led_{tag}"
    make = lambda rows: spark.createDataFrame(rows, COLUMNS)
    K.create_partitioned(make(_rows(60, 5) + _rows(60, 6) + _rows(60, 7)), name, "month", path=scratch_path(spark, name))
    members = spark.createDataFrame([("4400000001",), ("9900000005",)], "device string")
    device = spark.createDataFrame([("4400000002", "smart_etc_1"), ("4500000004", "plain")], "obuid string, openname string")
    tables = S.ReportTables(f"enr_{tag}", f"sum_{tag}", f"wai_{tag}")
    locations = {n: scratch_path(spark, f"{n}{tag}") for n in ("enriched", "summary", "waiver", "summary_parts", "waiver_parts", "devices", "waived")}
    ledger = lambda: spark.table(name)
    go = lambda m, d, written: S.refresh_reports(spark, ledger(), m, d, tables, written, locations)

    assert go(members, device, None)["enriched"] == ["2001-05", "2001-06", "2001-07"]
    _same(spark, tables, ledger(), members, device)

    # a day of the window: no device changed, no pair waived anew, so no other month
    more = [r for r in _rows(50, 7, seed=0) if r[9] != "waiver"] + [r for r in _rows(60, 7) if r[9] == "waiver"]
    written = K.overwrite_partitions(make(more), name, clear=["2001-07"])
    assert written == ["2001-07"]
    assert go(members, device, written) == {"enriched": ["2001-07"], "waiver": ["2001-07"]}
    _same(spark, tables, ledger(), members, device)

    # devices with a new name or membership: their months are rewritten too
    named = device.unionByName(spark.createDataFrame([("4500000004", "smart_etc_9"), ("1234", "new")], device.schema))
    joined = members.unionByName(spark.createDataFrame([("4500000010",)], members.schema))
    touched = {r["month"] for r in ledger().where(F.col("obu_id").isin("4500000004", "4500000010")).select("month").collect()}
    assert touched - {"2001-07"}
    assert set(go(joined, named, ["2001-07"])["enriched"]) == touched | {"2001-07"}
    _same(spark, tables, ledger(), joined, named)

    # a pair waived in the window marks the device's older days, and no longer waived unmarks them
    base = ledger().where((F.col("scene2") == "all_devices") & (F.col("segment") == L.TRUCK) & (F.col("month") == "2001-05") & F.col("obu_id").isNotNull()).first()
    waiver = (date(2001, 7, 3), L.SIGNING, base["buyer"], Decimal(0), None, base["obu_id"], L.RECEIVABLE, L.RECEIVABLE, L.TRUCK, "waiver", Decimal(0), "2001-07")
    for rows in (more + [waiver], [r for r in more if r[9] != "waiver"]):
        months = go(joined, named, K.overwrite_partitions(make(rows), name, clear=["2001-07"]))
        assert months["enriched"] == ["2001-07"]
        _same(spark, tables, ledger(), joined, named)

    # an older month that a late correction made the run write
    late = [(*r[:11], "2001-05") if i == 0 else r for i, r in enumerate(more)]
    held = [tuple(r) for r in ledger().where("month = '2001-05'").select(*[c.split()[0] for c in COLUMNS.split(", ")]).collect()]
    written = K.overwrite_partitions(make(late + held), name, clear=["2001-07"])
    assert written == ["2001-05", "2001-07"]
    go(joined, named, written)
    _same(spark, tables, ledger(), joined, named)


def test_a_day_reads_only_the_partitions_it_wrote(spark):
    """The rows that the reports are made from come from the written months' files alone."""
    name = f"pr_{uuid.uuid4().hex[:6]}"
    K.create_partitioned(spark.createDataFrame(_rows(60, 5) + _rows(60, 6) + _rows(60, 7), COLUMNS), name, "month", path=scratch_path(spark, name))
    devices = S.device_dimension(spark.createDataFrame([("4400000001",)], "device string"), spark.createDataFrame([("44", "x")], "obuid string, openname string"))
    own = spark.table(name).where(F.col("month").isin("2001-07"))
    for df in (S.enrich_from(own, devices), S.waived_pairs(own), S.waiver_parts(own.where(S.month_of("date").isin("2001-07")), S.waived_pairs(own))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(month" in plan and "= 2001-07)" in plan
