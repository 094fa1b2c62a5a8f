from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.operators import filters, quality, recon

D = dt.date
ORDERS = "order_id string, order_date date, sales decimal(18,2), customer_name string, order_status string, customer_id string"
INVOICES = "order_id string, invoice_date date, invoice_amount decimal(18,2), payment_status string, customer_name string"


def order(key, sales="100.00", status="COMPLETE", day=D(2024, 1, 10)):
    return (key, day, Decimal(sales) if sales else None, f"Customer {key}", status, f"C{key}")


def invoice(key, amount="100.00", state="Paid", day=D(2024, 1, 10)):
    return (key, day, Decimal(amount) if amount else None, state, f"Customer {key}")


@pytest.fixture
def case(spark):
    orders = [
        order("ok"),
        order("tie"),
        order("off"),
        order("alone"),
        order("dead_invoice"),
        order("canceled", status="CANCELED"),
        order("fraud", status="SUSPECTED_FRAUD"),
        order("one_day"),
        order("two_days"),
        order("no_status", status=None),
        order("no_amount", sales=None),
    ]
    invoices = [
        invoice("ok"),
        invoice("tie", "100.01"),
        invoice("off", "100.02"),
        invoice("dead_invoice", state="Cancelled"),
        invoice("canceled"),
        invoice("fraud"),
        invoice("one_day", day=D(2024, 1, 11)),
        invoice("two_days", day=D(2024, 1, 12)),
        invoice("no_amount"),
        invoice("ghost"),
    ]
    return spark.createDataFrame(orders, ORDERS), spark.createDataFrame(invoices, INVOICES)


def test_full_classifies_each_trap(case):
    found = {r.order_id: r.status for r in recon.full(*case).collect()}
    assert found == {
        "ok": "OK",
        "tie": "OK",
        "off": "AMOUNT_MISMATCH",
        "alone": "OPS_ONLY",
        "dead_invoice": "OPS_ONLY",
        "canceled": "EXCLUDED",
        "fraud": "EXCLUDED",
        "one_day": "OK",
        "two_days": "DATE_MISMATCH",
        "no_status": "EXCLUDED",
        "no_amount": "OK",
        "ghost": "FIN_ONLY",
    }


def test_single_operators_agree_with_full(case, rows):
    orders, invoices = case
    compared = recon.full(orders, invoices)
    by = {s: rows(compared.where(F.col("status") == s), "order_id") for s in ("OPS_ONLY", "FIN_ONLY", "AMOUNT_MISMATCH")}
    assert rows(recon.missing_ar(orders, invoices), "order_id") == by["OPS_ONLY"]
    assert rows(recon.ghost_invoices(orders, invoices), "order_id") == by["FIN_ONLY"]
    assert rows(recon.amount_mismatch(orders, invoices), "order_id") == by["AMOUNT_MISMATCH"]
    assert rows(recon.missing_ar(orders, invoices, live_only=False), "order_id") == [("alone",)]
    assert rows(recon.date_mismatch(orders, invoices), "order_id", "days_apart") == [("two_days", 2)]


def test_presets_and_missing_status(case):
    orders, _ = case
    names = {r.order_id for r in filters.active_orders(orders, "strict").collect()}
    assert "fraud" not in names and "no_status" not in names
    assert "fraud" in {r.order_id for r in filters.active_orders(orders, "basic").collect()}
    assert "no_status" in {r.order_id for r in filters.active_orders(orders, keep_null_status=True).collect()}


def test_summary_tells_key_match_from_full_match(case):
    row = recon.summary(recon.full(*case)).collect()[0]
    assert (row.ops_orders, row.key_matched, row.fully_matched) == (8, 6, 4)
    assert (row.missing_in_fin, row.ghost_invoices, row.amount_mismatched, row.date_mismatched) == (2, 1, 1, 1)


def test_exceptions_newest_first(spark, case):
    orders, invoices = case
    later = orders.unionByName(spark.createDataFrame([order("newer", day=D(2024, 2, 1))], ORDERS))
    found = [(r.order_id, r.reconciliation_status) for r in recon.exceptions(later, invoices).collect()]
    assert found[0] == ("newer", "MISSING_IN_FINANCE")
    assert ("off", "AMOUNT_MISMATCH") in found and ("tie", "OK") not in found


def test_leakage_counts_an_order_once(spark, case):
    orders, invoices = case
    shipped = spark.createDataFrame(
        [("alone", D(2024, 1, 5))] * 3 + [("ok", D(2024, 1, 5)), ("alone", D(2024, 3, 1))],
        "order_id string, shipping_date date",
    )
    row = recon.leakage(orders, shipped, invoices, "2024-01-01", "2024-01-31").collect()[0]
    assert (row.leaked_orders, row.leaked_sales) == (1, Decimal("100.00"))
    none = recon.leakage(orders, shipped, invoices, "2023-01-01", "2023-01-31").collect()[0]
    assert (none.leaked_orders, none.leaked_sales) == (0, Decimal("0.00"))


def test_handling_and_drafts(case):
    orders, invoices = case
    steps = {r.order_id: r.handling for r in recon.handling(recon.full(orders, invoices)).collect()}
    assert steps["alone"] == "AUTO_DRAFT_AR" and steps["ghost"] == "MANUAL_REVIEW"
    assert steps["off"] == "DIFFERENCE_ANALYSIS" and steps["one_day"] == "ACCEPT_WITHIN_TOLERANCE"
    assert "ok" not in steps
    draft = recon.draft_ar(orders, invoices).collect()
    assert [(r.order_id, r.due_date, r.payment_status) for r in draft] == [("alone", D(2024, 2, 9), "Outstanding")]


def test_empty_inputs(spark):
    orders, invoices = spark.createDataFrame([], ORDERS), spark.createDataFrame([], INVOICES)
    compared = recon.full(orders, invoices)
    assert set(recon.summary(compared).collect()[0]) == {0}
    assert recon.audit_row(compared, "2024-01-01 00:00:00").collect()[0].execution_status == "NO_DATA"
    assert quality.alert_level(compared).collect()[0].alert_level == "EMERGENCY"
    verdicts = {r.check_name: r.verdict for r in quality.control_checks(compared, orders).collect()}
    assert set(verdicts.values()) == {"NOT_COMPUTABLE"}
    assert recon.control_report(compared).collect()[0].match_rate == 0.0


def test_match_ledger_uses_first_order_and_strict_tolerance(spark):
    orders = spark.createDataFrame(
        [("o1", Decimal("10.00"), 0), ("o1", Decimal("99.00"), 1), ("o2", Decimal("20.00"), 2)],
        "order_id string, sales decimal(18,2), seq int",
    )
    ledger = spark.createDataFrame(
        [("t1", "o1", Decimal("10.00")), ("t2", "o2", Decimal("20.01")), ("t3", "zz", Decimal("1.00"))],
        "transaction_id string, order_id string, amount decimal(18,2)",
    )
    matches = recon.match_ledger(orders, ledger, "seq")
    found = {r.transaction_id: (r.match_status, r.severity) for r in matches.collect()}
    assert found == {"t1": ("MATCHED", "INFO"), "t2": ("MISMATCH", "WARNING")}
    texts = {r.description for r in matches.collect()}
    assert "Order o1: MATCHED (Ops: 10.00, Fin: 10.00)" in texts
    row = recon.match_summary(orders, matches).collect()[0]
    assert (row.total_orders, row.matched, row.mismatched, row.match_rate) == (3, 1, 1, 33.3)


def test_counts_add_up_on_random_rows(spark):
    rnd = random.Random(11)
    states = ["COMPLETE", "CANCELED", "SUSPECTED_FRAUD", "PROCESSING", None]
    orders = spark.createDataFrame(
        [order(f"o{i}", f"{rnd.randrange(100)}.00", rnd.choice(states)) for i in range(300)], ORDERS
    )
    invoices = spark.createDataFrame(
        [invoice(f"o{i}", f"{rnd.randrange(100)}.00", rnd.choice(["Paid", "Cancelled"])) for i in range(100, 400)],
        INVOICES,
    )
    row = recon.summary(recon.full(orders, invoices)).collect()[0]
    active = filters.active_orders(orders).count()
    assert row.ops_orders == active == row.missing_in_fin + row.key_matched
    assert row.ghost_invoices == 100
    check = quality.left_join_integrity(orders, invoices, "order_id").collect()[0]
    assert (check.left_rows, check.joined_rows, check.integrity) == (300, 300, "PASSED")
