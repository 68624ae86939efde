"""Service movements: other services (D9), after-sales and cancellation
(D11), monthly debit/refund totals (D10).  D9 and D11 read one snapshot of
the service detail table once and expand each row into the movement arms it
satisfies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline import labels as L
from ledgerline.context import RunContext
from ledgerline.functions.rules import not_blank, not_in
from ledgerline.operators.aggregate import monthly_flows, summarise
from ledgerline.operators.movements import MovementSpec, expand_movements
from ledgerline.sources.snapshot import movement_slice, month_from

# fixed values: D9 exclusions
MAIN_SCENES = [L.SERVICE_NEW, L.SERVICE_REPLACE, L.SERVICE_CANCEL, L.SERVICE_REBIND_REFUND]
EXCLUDED_OPEN_NAMES = ["excluded_channel", "excluded_bank_wechat", "excluded_bank_app"]
# fixed values: D11 department excluded, D10 department and floor
ETC_DEPARTMENT = "etc"
DEBIT_DEPARTMENT = "etc"
DEBIT_FLOOR = "2000-03"
REFUND_DONE = "REFUND_SUCCESS"  # refund state used by the strict refund totals

OTHER_COLUMNS = ["sale_department", "service_scene2", "date", "obu_id", "price", "id", "ds", "scene", "data_type"]
AFTERSALES_COLUMNS = ["data_type", "scene", "adjust_type", "sale_department", "date", "obu_id", "price", "id", "ds"]
TYPES = {"date": "timestamp_ntz", "price": "decimal(18,2)", "id": "string", "obu_id": "string"}


def _month_and_date(df: DataFrame, columns: list[str]) -> DataFrame:
    out = [F.to_date("date").alias("date") if c == "date" else F.col(c) for c in columns]
    return df.select(*out, F.date_format("date", "yyyy-MM").alias("month"))


def _owned(rows: DataFrame, ctx: RunContext, mode: str, months: list[str] | None) -> DataFrame:
    """Movements that the run owns.  An incremental run owns its window; a rebuild owns
    every month once, from the snapshot that closes it (or today's)."""
    if mode == "incremental":
        return rows.where(month_from(rows, "date", ctx.window_start))
    wanted = months or ctx.rebuild_months
    closing = F.create_map(*[F.lit(x) for m in wanted for x in (m, ctx.closing_ds(m))])
    # today's snapshot also holds what is dated ahead
    ahead = (F.col("ds") == F.lit(ctx.ds)) & (F.col("month") > F.lit(ctx.month)) if not months else F.lit(False)
    return rows.where((F.element_at(closing, F.col("month")) == F.col("ds")) | ahead)


def other_movements(detail: DataFrame, ctx: RunContext, parity_constant_id: bool = False,
                    adjustments: DataFrame | None = None, mode: str = "incremental",
                    months: list[str] | None = None) -> DataFrame:
    """Receivable, receivable decrease, received, received decrease, plus
    an optional hand-loaded adjustment table already shaped like the output
    (selected by name); the window and device filters apply to all of them."""
    c = F.col
    x = movement_slice(detail, ctx, ["obu_should_time", "should_refund_time", "actual_time"], mode, months).where(
        not_in(c("service_scene2"), MAIN_SCENES)
        & not_in(c("openname"), EXCLUDED_OPEN_NAMES, keep_null=True)
        & c("stock_type").isNull()
    )
    amount_ok = (c("should_amount") != 0) & c("should_amount").isNotNull()
    collect, refund = c("service_type") == F.lit(L.COLLECT), c("service_type") == F.lit(L.REFUND)
    common = {"sale_department": c("sale_department"), "service_scene2": c("service_scene2"),
              "obu_id": c("obu_id"), "ds": c("ds"), "data_type": L.NORMAL}
    arms = [
        MovementSpec("receivable", collect & c("obu_should_time").isNotNull() & amount_ok,
                     {**common, "date": c("obu_should_time"), "price": c("should_amount"), "id": c("id"),
                      "scene": L.RECEIVABLE}),
        MovementSpec("receivable_decrease", refund & c("should_refund_time").isNotNull() & amount_ok,
                     {**common, "date": c("should_refund_time"), "price": -c("should_amount"), "id": c("id"),
                      "scene": L.RECEIVABLE_DECREASE}),
        MovementSpec("received", collect & c("actual_time").isNotNull(),
                     {**common, "date": F.to_date("actual_time"), "price": c("actual_amount"), "id": c("id"),
                      "scene": L.RECEIVED}),
        MovementSpec("received_decrease", refund & c("actual_time").isNotNull(),
                     {**common, "date": F.to_date("actual_time"), "price": -c("actual_amount"),
                      "id": F.lit("1") if parity_constant_id else c("id"), "scene": L.RECEIVED_DECREASE}),
    ]
    rows = expand_movements(x, arms, OTHER_COLUMNS, TYPES)
    out = _month_and_date(rows, OTHER_COLUMNS)
    if adjustments is not None:
        extra = adjustments.select(*[c(n).cast(out.schema[n].dataType) for n in out.columns])
        if mode == "incremental":
            out = _owned(out, ctx, mode, months).unionByName(extra.where(month_from(extra, "date", ctx.window_start)))
        else:
            # only months that the run rebuilds (and what is dated ahead): others stay as they are
            own = c("month").isin(months or ctx.rebuild_months)
            extra = extra.where(own if months else own | (c("month") > F.lit(ctx.month)))
            out = _owned(out, ctx, mode, months).unionByName(extra)
    else:
        out = _owned(out, ctx, mode, months)
    return out.where(not_blank(c("obu_id")))


def other_summary(movements: DataFrame) -> DataFrame:
    return summarise(movements, ["data_type", "sale_department", "service_scene2", "scene", "date", "price"],
                     "obu_id", "price")


def aftersales_movements(detail: DataFrame, ctx: RunContext, parity_constant_id: bool = False,
                         mode: str = "incremental", months: list[str] | None = None) -> DataFrame:
    """{after-sales, cancellation} x {receivable, received} x {collect, refund}."""
    c = F.col
    times = ["obu_should_time", "card_should_time", "should_refund_time", "actual_time"]
    x = movement_slice(detail, ctx, times, mode, months).where(c("sale_department") != F.lit(ETC_DEPARTMENT))
    collect, refund = c("service_type") == F.lit(L.COLLECT), c("service_type") == F.lit(L.REFUND)
    replace1, cancel1 = c("service_scene") == F.lit(L.SERVICE_REPLACE), c("service_scene") == F.lit(L.SERVICE_CANCEL)
    replace2, cancel2 = c("service_scene2") == F.lit(L.SERVICE_REPLACE), c("service_scene2") == F.lit(L.SERVICE_CANCEL)
    amount_ok = (c("should_amount") != 0) & c("should_amount").isNotNull()
    dev_or_id = F.coalesce(c("obu_id"), c("id"))
    cancel_time = F.coalesce(c("obu_should_time"), c("card_should_time"))
    const_id = F.lit("1") if parity_constant_id else c("id")
    R, RD, AS, CP = L.RECEIVABLE, L.RECEIVED, L.AFTER_SALES_PAID, L.CANCEL_PAID

    def arm(name, where, data_type, scene, adjust, date, key, price, id_=None):
        return MovementSpec(name, where, {
            "data_type": data_type, "scene": scene, "adjust_type": adjust, "sale_department": c("sale_department"),
            "date": date, "obu_id": key, "price": price, "id": c("id") if id_ is None else id_, "ds": c("ds")})

    arms = [
        arm("as_receivable", replace1 & collect & c("obu_should_time").isNotNull() & amount_ok,
            R, AS, R, F.to_date("obu_should_time"), c("obu_id"), c("should_amount")),
        arm("as_received", replace1 & collect & c("actual_time").isNotNull(),
            RD, AS, RD, F.to_date("actual_time"), c("obu_id"), c("actual_amount")),
        arm("cancel_receivable", cancel1 & collect & cancel_time.isNotNull(),
            R, CP, R, F.to_date(cancel_time), dev_or_id, F.coalesce(c("should_amount"), F.lit(0))),
        arm("cancel_received", cancel1 & collect & c("actual_time").isNotNull(),
            RD, CP, RD, F.to_date("actual_time"), dev_or_id, c("actual_amount")),
        arm("as_receivable_decrease", replace2 & refund & c("should_refund_time").isNotNull() & amount_ok,
            R, AS, L.DECREASE, c("should_refund_time"), c("obu_id"), -c("should_amount")),
        arm("cancel_receivable_decrease", cancel2 & refund & c("should_refund_time").isNotNull() & amount_ok,
            R, CP, L.DECREASE, c("should_refund_time"), dev_or_id, -c("should_amount")),
        arm("as_received_decrease", replace2 & refund & c("actual_time").isNotNull(),
            RD, AS, L.DECREASE, F.to_date("actual_time"), c("obu_id"), -c("actual_amount"), const_id),
        arm("cancel_received_decrease", cancel2 & refund & c("actual_time").isNotNull(),
            RD, CP, L.DECREASE, F.to_date("actual_time"), c("obu_id"), -c("actual_amount"), const_id),
    ]
    rows = expand_movements(x, arms, AFTERSALES_COLUMNS, TYPES)
    return _owned(_month_and_date(rows, AFTERSALES_COLUMNS), ctx, mode, months)


def aftersales_summary(movements: DataFrame) -> DataFrame:
    return summarise(movements, ["data_type", "scene", "adjust_type", "sale_department", "date", "price"],
                     "obu_id", "price")


def debit_refund_totals(equipment: DataFrame, floor: str = DEBIT_FLOOR, strict: bool = False) -> DataFrame:
    """Monthly debit (by pay time) and refund (by refund time) totals of
    successful payments of one department, one scan + one aggregate.

    Default (as modelled, Q4): refunds filter the *pay* state and are summed
    as positive amounts.  ``strict=True``: refunds filter the refund state and
    are negated, like the card-swap refund feed.
    """
    c = F.col
    dept = c("department") == F.lit(DEBIT_DEPARTMENT)
    paid = (c("pay_state") == F.lit("SUCCESS")) & dept
    refunded = ((c("refund_state") == F.lit(REFUND_DONE)) & dept) if strict else paid
    amount = c("equipment_amount")
    # the floor reaches the scan: a row counts if either of its times is on or after it
    equipment = equipment.where(month_from(equipment, "gmt_payment", floor) | month_from(equipment, "gmt_refund", floor))
    return monthly_flows(equipment, [
        ("debit", paid & month_from(equipment, "gmt_payment", floor), c("gmt_payment"), amount),
        ("refund", refunded & month_from(equipment, "gmt_refund", floor), c("gmt_refund"),
         -amount if strict else amount),
    ], amount)
