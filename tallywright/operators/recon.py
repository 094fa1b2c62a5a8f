"""Operations against finance: the reconciliation itself.

Contract: ``orders`` holds one row per ``order_id`` and ``invoices`` one row per
``order_id`` (``quality.duplicate_keys`` checks it, ``windows.keep_last`` makes it
so).  The joins are then 1:1 and cannot fan out, however the keys are spread.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from tallywright.functions import dates, money
from tallywright.functions.hashing import content_id
from tallywright.operators import filters, ingest, joins, windows

DATE_TOLERANCE_DAYS = 1

# Outcome of the full comparison and what is done about it.
HANDLING = {
    "OPS_ONLY": "AUTO_DRAFT_AR",
    "FIN_ONLY": "MANUAL_REVIEW",
    "AMOUNT_MISMATCH": "DIFFERENCE_ANALYSIS",
    "DATE_MISMATCH": "MANUAL_REVIEW",
}


def _ops_side(orders: DataFrame, preset: str) -> DataFrame:
    active = filters.active_orders(orders, preset)
    return active.select("order_id", "order_status", F.col("sales").alias("expected_revenue"), "customer_name")


def _fin_side(invoices: DataFrame) -> DataFrame:
    return filters.live_invoices(invoices).select("order_id", F.col("invoice_amount").alias("booked_revenue"))


def reconcile(orders: DataFrame, invoices: DataFrame, preset: str = "strict") -> DataFrame:
    """Active orders left-joined to live invoices, with the match mark and the gap."""
    fin = _fin_side(invoices).withColumn("_booked", F.lit(True))
    joined = joins.outer_join(_ops_side(orders, preset), fin, "order_id", "left")
    return joined.select(
        "order_id",
        "order_status",
        "expected_revenue",
        "customer_name",
        "booked_revenue",
        F.when(F.col("_booked"), "both").otherwise("left_only").alias("match_state"),
        F.abs(F.col("expected_revenue") - F.col("booked_revenue")).alias("diff"),
    )


def missing_ar(
    orders: DataFrame, invoices: DataFrame, preset: str = "strict", live_only: bool = True
) -> DataFrame:
    """Active orders without an invoice (``live_only``: without one that still counts)."""
    fin = filters.live_invoices(invoices) if live_only else invoices
    return joins.anti_join(_ops_side(orders, preset), fin, "order_id")


def ghost_invoices(orders: DataFrame, invoices: DataFrame) -> DataFrame:
    """Invoices whose order exists in no status at all."""
    fin = invoices.select("order_id", "invoice_amount", "customer_name")
    return joins.anti_join(fin, orders, "order_id").withColumn("orphan_type", F.lit("ORPHAN_FIN_ONLY"))


def amount_mismatch(
    orders: DataFrame,
    invoices: DataFrame,
    preset: str = "strict",
    tolerance: Decimal = money.AMOUNT_TOLERANCE,
    tie_differs: bool = False,
) -> DataFrame:
    """Matched pairs whose amounts are further apart than the tolerance."""
    pairs = _ops_side(orders, preset).join(_fin_side(invoices), "order_id")
    left, right = F.col("expected_revenue"), F.col("booked_revenue")
    return pairs.where(money.amount_differs(left, right, tolerance, tie_differs)).select(
        "order_id", "customer_name", "expected_revenue", "booked_revenue", F.abs(left - right).alias("diff")
    )


def date_mismatch(
    orders: DataFrame, invoices: DataFrame, preset: str = "strict", tolerance_days: int = DATE_TOLERANCE_DAYS
) -> DataFrame:
    """Matched pairs whose dates are more than ``tolerance_days`` apart."""
    ops = filters.active_orders(orders, preset).select("order_id", "order_date")
    fin = filters.live_invoices(invoices).select("order_id", "invoice_date")
    gap = dates.days_between(F.col("invoice_date"), F.col("order_date"))
    return ops.join(fin, "order_id").where(F.abs(gap) > tolerance_days).withColumn("days_apart", gap)


def match_ledger(orders: DataFrame, ledger: DataFrame, order_seq: Column | str | None = None) -> DataFrame:
    """Ledger rows against the first order of the same id, amounts strictly within 0.01.

    ``order_seq`` names the input order when an id may occur more than once; ledger
    rows without an order are left out.
    """
    ops = orders.select("order_id", "sales", *([order_seq] if isinstance(order_seq, str) else []))
    if order_seq is not None:
        ops = windows.keep_first(ops, "order_id", order_seq)
    pairs = joins.join_to_unique(
        ledger.select("transaction_id", "order_id", F.col("amount").alias("fin_amount")),
        ops.select("order_id", F.col("sales").alias("ops_amount")),
        "order_id",
    )
    differs = money.amount_differs(F.col("fin_amount"), F.col("ops_amount"), tie_differs=True)
    # A missing amount is no match here.
    matched = ~differs & F.col("fin_amount").isNotNull() & F.col("ops_amount").isNotNull()
    status = F.when(matched, "MATCHED").otherwise("MISMATCH")
    return pairs.select(
        "transaction_id",
        "order_id",
        "ops_amount",
        "fin_amount",
        status.alias("match_status"),
        F.when(matched, "INFO").otherwise("WARNING").alias("severity"),
        F.concat(
            F.lit("Order "),
            F.col("order_id"),
            F.lit(": "),
            status,
            F.lit(" (Ops: "),
            F.coalesce(F.col("ops_amount").cast("string"), F.lit("none")),
            F.lit(", Fin: "),
            F.coalesce(F.col("fin_amount").cast("string"), F.lit("none")),
            F.lit(")"),
        ).alias("description"),
    )


def match_summary(orders: DataFrame, matches: DataFrame) -> DataFrame:
    """Totals and match rate over all orders, one row."""
    # Both inputs shrink to one row per task before they meet.
    parts = orders.agg(F.count("*").alias("orders"), F.lit(0).cast("bigint").alias("m"), F.lit(0).cast("bigint").alias("x"))
    hits = matches.agg(
        F.lit(0).cast("bigint").alias("orders"),
        F.count_if(F.col("match_status") == "MATCHED").alias("m"),
        F.count_if(F.col("match_status") == "MISMATCH").alias("x"),
    )
    return (
        parts.unionByName(hits)
        .agg(F.sum("orders").alias("total_orders"), F.sum("m").alias("matched"), F.sum("x").alias("mismatched"))
        .withColumn("match_rate", F.bround(money.ratio(F.col("matched"), F.col("total_orders")) * 100, 1))
    )


def exceptions(orders: DataFrame, invoices: DataFrame, preset: str = "strict") -> DataFrame:
    """Missing and mismatching orders against all invoices, newest first.

    The id breaks ties, so the range sort can also split one busy day.
    """
    ops = filters.active_orders(orders, preset).select(
        "order_id", "order_date", F.col("sales").alias("expected_revenue"), "customer_name"
    )
    fin = invoices.select("order_id", F.col("invoice_amount").alias("booked_revenue"), F.lit(True).alias("_booked"))
    joined = joins.outer_join(ops, fin, "order_id", "left")
    differs = money.amount_differs(F.col("expected_revenue"), F.col("booked_revenue"))
    status = F.when(F.col("_booked").isNull(), "MISSING_IN_FINANCE").when(differs, "AMOUNT_MISMATCH").otherwise("OK")
    return (
        joined.withColumn("reconciliation_status", status)
        .where(F.col("_booked").isNull() | differs)
        .select(
            "order_id", "order_date", "expected_revenue", "customer_name", "booked_revenue", "reconciliation_status"
        )
        .orderBy(F.desc("order_date"), "order_id")
    )


def full_ops(orders: DataFrame, preset: str = "strict") -> DataFrame:
    """All orders, marked as in scope or not."""
    return orders.select(
        "order_id",
        "order_date",
        "customer_name",
        "sales",
        filters.is_active(preset).alias("active"),
        F.lit(True).alias("_ops"),
    )


def full_fin(invoices: DataFrame) -> DataFrame:
    """All invoices, marked as live or not."""
    return invoices.select(
        "order_id",
        "invoice_date",
        "invoice_amount",
        F.coalesce(F.col("payment_status") != filters.DEAD_INVOICE, F.lit(False)).alias("live"),
        F.lit(True).alias("_fin"),
    )


def full(
    orders: DataFrame,
    invoices: DataFrame,
    preset: str = "strict",
    tolerance: Decimal = money.AMOUNT_TOLERANCE,
    tolerance_days: int = DATE_TOLERANCE_DAYS,
) -> DataFrame:
    """Every order and every invoice once, classified.

    Both inputs come in unfiltered: an invoice of a cancelled order is EXCLUDED,
    not a ghost.  A cancelled invoice does not cover its order.  All counts, rates
    and reports of a run are aggregates of this one join.
    """
    joined = joins.outer_join(full_ops(orders, preset), full_fin(invoices), "order_id", "full_outer")
    return classify(joined, tolerance, tolerance_days)


def classify(
    joined: DataFrame, tolerance: Decimal = money.AMOUNT_TOLERANCE, tolerance_days: int = DATE_TOLERANCE_DAYS
) -> DataFrame:
    """Outcome per row of an outer join marked with ``_ops`` and ``_fin``; batch and stream."""
    in_ops = F.coalesce(F.col("_ops"), F.lit(False))
    in_fin = F.coalesce(F.col("_fin"), F.lit(False))
    active = F.coalesce(F.col("active"), F.lit(False))
    live = F.coalesce(F.col("live"), F.lit(False))
    days_apart = dates.days_between(F.col("invoice_date"), F.col("order_date"))
    status = (
        F.when(~in_ops, "FIN_ONLY")
        .when(~active, "EXCLUDED")
        .when(~live, "OPS_ONLY")
        .when(money.amount_differs(F.col("sales"), F.col("invoice_amount"), tolerance), "AMOUNT_MISMATCH")
        .when(F.abs(days_apart) > tolerance_days, "DATE_MISMATCH")
        .otherwise("OK")
    )
    return joined.select(
        "order_id",
        "order_date",
        "invoice_date",
        "customer_name",
        "sales",
        "invoice_amount",
        in_ops.alias("in_ops"),
        in_fin.alias("in_fin"),
        active.alias("active"),
        live.alias("live"),
        F.abs(F.col("sales") - F.col("invoice_amount")).alias("amount_diff"),
        days_apart.alias("days_apart"),
        status.alias("status"),
    )


def leakage(
    orders: DataFrame,
    shipments: DataFrame,
    invoices: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    preset: str = "basic",
) -> DataFrame:
    """Orders shipped in the range without any invoice: how many and how much.

    Shipments collapse to their order ids before anything is joined, so an order
    with many lines counts once and cannot become a hot key.
    """
    shipped = filters.date_range(shipments, start, end, column="shipping_date").select("order_id").distinct()
    lost = (
        filters.active_orders(orders, preset)
        .select("order_id", "sales")
        .join(shipped, "order_id", "left_semi")
        .join(invoices.select("order_id"), "order_id", "left_anti")
    )
    return lost.agg(
        F.count("*").alias("leaked_orders"), F.coalesce(F.sum("sales"), F.lit(Decimal("0.00"))).alias("leaked_sales")
    )


def summary_counts() -> list[Column]:
    """Counts of :func:`summary`, sums over the rows of a comparison."""

    def n(condition: Column) -> Column:
        return F.count_if(condition)

    status = F.col("status")
    return [
        n(F.col("active")).alias("ops_orders"),
        n(F.col("live")).alias("fin_records"),
        n(F.col("active") & F.col("live")).alias("key_matched"),
        n(status == "OK").alias("fully_matched"),
        n(status == "OPS_ONLY").alias("missing_in_fin"),
        n(status == "FIN_ONLY").alias("ghost_invoices"),
        n(F.col("active") & F.col("live") & money.amount_differs(F.col("sales"), F.col("invoice_amount"))).alias(
            "amount_mismatched"
        ),
        n(status == "DATE_MISMATCH").alias("date_mismatched"),
    ]


def summary(compared: DataFrame) -> DataFrame:
    """Counts of one comparison (:func:`full`), one row.

    ``key_matched`` holds every active order with a live invoice, ``fully_matched``
    only those that agree in amount and date.
    """
    return compared.agg(*summary_counts())


def audit_counts() -> list[Column]:
    """Counts of :func:`audit_row`, sums over the rows of a comparison."""
    return [
        F.count_if("in_ops").alias("total_ops_records"),
        F.count_if("in_fin").alias("total_fin_records"),
        F.count_if(F.col("status") == "OK").alias("matched_records"),
        F.count_if(F.col("status") == "OPS_ONLY").alias("orphan_ops_count"),
        F.count_if(F.col("status") == "FIN_ONLY").alias("orphan_fin_count"),
        F.count_if(F.col("status") == "AMOUNT_MISMATCH").alias("amount_mismatch_count"),
    ]


def audit_row(
    compared: DataFrame, as_of: str, period: str = "all", executed_by: str = "scheduler", notes: str | None = None
) -> DataFrame:
    """The run's line for ``reconciliation_audit``; a rerun gives the same id."""
    return audit_line(compared.agg(*audit_counts()), as_of, period, executed_by, notes)


def audit_line(
    counts: DataFrame, as_of: str, period: str = "all", executed_by: str = "scheduler", notes: str | None = None
) -> DataFrame:
    """:func:`audit_row` of counts that are there already."""
    return counts.select(
        content_id(F.lit(as_of), F.lit(period), F.lit(executed_by)).alias("audit_id"),
        F.lit(as_of).cast("timestamp").alias("audit_date"),
        F.lit(period).alias("reconciliation_period"),
        *counts.columns,
        F.lit(executed_by).alias("executed_by"),
        F.when(F.col("total_ops_records") + F.col("total_fin_records") > 0, "COMPLETED")
        .otherwise("NO_DATA")
        .alias("execution_status"),
        F.lit(notes).cast("string").alias("notes"),
    )


def report_counts() -> list[Column]:
    """Counts and amounts of :func:`control_report`, sums over the rows of a comparison."""
    status = F.col("status")
    orphan = status.isin("OPS_ONLY", "FIN_ONLY")
    auto, review = _handled_automatically(), _needs_review()
    return [
        F.count_if("active").alias("total_ops_orders"),
        F.count_if("in_fin").alias("total_fin_records"),
        F.count_if(F.col("active") & F.col("live")).alias("matched_count"),
        F.count_if(status == "OPS_ONLY").alias("ops_orphan_count"),
        F.count_if(status == "FIN_ONLY").alias("fin_orphan_count"),
        F.count_if(orphan).alias("_orphans"),
        F.count("*").alias("_all"),
        F.count_if(status == "AMOUNT_MISMATCH").alias("amount_mismatch_count"),
        F.coalesce(F.sum(F.when(status == "AMOUNT_MISMATCH", F.col("amount_diff"))), F.lit(Decimal("0.00"))).alias(
            "amount_mismatch_total"
        ),
        F.count_if(status == "DATE_MISMATCH").alias("date_mismatch_count"),
        F.count_if(auto).alias("auto_resolved"),
        F.count_if(review).alias("pending_review"),
        F.count_if(status == "AMOUNT_MISMATCH").alias("confirmed_anomaly"),
    ]


def control_report(compared: DataFrame) -> DataFrame:
    """Figures of the control report: totals, orphans, differences, handling state."""
    return report_line(compared.agg(*report_counts()))


def report_line(counts: DataFrame) -> DataFrame:
    """:func:`control_report` of counts that are there already."""
    return counts.select(
        "total_ops_orders",
        "total_fin_records",
        "matched_count",
        F.bround(money.ratio(F.col("matched_count"), F.col("total_ops_orders")) * 100, 2).alias("match_rate"),
        "ops_orphan_count",
        "fin_orphan_count",
        F.bround(money.ratio(F.col("_orphans"), F.col("_all")) * 100, 2).alias("orphan_rate"),
        "amount_mismatch_count",
        "amount_mismatch_total",
        "date_mismatch_count",
        "auto_resolved",
        "pending_review",
        "confirmed_anomaly",
    )


def _handled_automatically() -> Column:
    """Draft invoices and date gaps inside the tolerance settle themselves."""
    within = (F.col("status") == "OK") & (F.col("days_apart") != 0)
    return (F.col("status") == "OPS_ONLY") | F.coalesce(within, F.lit(False))


def _needs_review() -> Column:
    return F.col("status").isin("FIN_ONLY", "DATE_MISMATCH")


def handling(compared: DataFrame) -> DataFrame:
    """Each finding of the comparison with what is done about it."""
    accepted = (F.col("status") == "OK") & (F.col("days_apart") != 0)
    action = F.when(accepted, "ACCEPT_WITHIN_TOLERANCE")
    for status, step in HANDLING.items():
        action = action.when(F.col("status") == status, step)
    return (
        compared.withColumn("handling", action)
        .where(F.col("handling").isNotNull())
        .select("order_id", "status", "handling", "amount_diff", "days_apart")
    )


def draft_ar(orders: DataFrame, invoices: DataFrame, preset: str = "strict") -> DataFrame:
    """Receivables proposed for active orders that have no invoice of any kind."""
    return ingest.receivables_of(joins.anti_join(filters.active_orders(orders, preset), invoices, "order_id"))
