"""Operations against finance."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from registry.base import BASIC, STRICT, Registry, sql_with
from tallywright.functions import dates
from tallywright.operators import recon
from tallywright.plans import full_audit
from tallywright.session import work_dir
from tallywright.sources import bindings
from tallywright.sources.comparison import Comparison

REGISTRY = Registry()
AS_OF = "2001-08-01 00:00:00"


def _orders(spark: SparkSession, folder: str, customer: bool = True) -> DataFrame:
    return bindings.sales_orders(spark, folder, customer=customer, profit=False)


def _compared(spark: SparkSession, folder: str, customer: bool = False) -> DataFrame:
    return recon.full(_orders(spark, folder, customer), bindings.accounts_receivable(spark, folder))


@REGISTRY.query(
    sql_with("so", "ar", body=f"""
        SELECT s.order_id, s.order_status, CAST(s.sales AS DOUBLE) AS expected_revenue, s.customer_name,
               CAST(a.invoice_amount AS DOUBLE) AS booked_revenue,
               CASE WHEN a.order_id IS NULL THEN 'left_only' ELSE 'both' END AS match_state,
               CAST(abs(s.sales - a.invoice_amount) AS DOUBLE) AS diff
        FROM so s LEFT JOIN (SELECT * FROM ar WHERE payment_status <> 'Cancelled') a ON s.order_id = a.order_id
        WHERE s.order_status NOT IN {STRICT}""")
)
def recon_left(spark: SparkSession, folder: str) -> DataFrame:
    return recon.reconcile(_orders(spark, folder), bindings.accounts_receivable(spark, folder))


@REGISTRY.query(
    sql_with("so", "ar", body=f"""
        SELECT order_id, order_status, CAST(sales AS DOUBLE) AS expected_revenue, customer_name FROM so
        WHERE order_status NOT IN {STRICT}
          AND NOT EXISTS (SELECT 1 FROM ar WHERE ar.order_id = so.order_id AND payment_status <> 'Cancelled')""")
)
def recon_missing_ar(spark: SparkSession, folder: str) -> DataFrame:
    return recon.missing_ar(_orders(spark, folder), bindings.accounts_receivable(spark, folder))


@REGISTRY.query(
    sql_with("so", "ar", body=f"""
        SELECT s.order_id, s.order_status, CAST(s.sales AS DOUBLE) AS expected_revenue, s.customer_name
        FROM so s LEFT JOIN ar ON s.order_id = ar.order_id
        WHERE ar.order_id IS NULL AND s.order_status NOT IN {STRICT}""")
)
def recon_orphan_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without an invoice of any state."""
    return recon.missing_ar(_orders(spark, folder), bindings.accounts_receivable(spark, folder), live_only=False)


@REGISTRY.query(
    sql_with("so", "ar", body="""
        SELECT f.order_id, CAST(f.invoice_amount AS DOUBLE) AS invoice_amount, f.customer_name, 'ORPHAN_FIN_ONLY' AS orphan_type
        FROM ar f LEFT JOIN so o ON f.order_id = o.order_id WHERE o.order_id IS NULL""")
)
def recon_ghost_invoice(spark: SparkSession, folder: str) -> DataFrame:
    invoices = bindings.accounts_receivable(spark, folder, customer=True)
    return recon.ghost_invoices(_orders(spark, folder, customer=False), invoices)


@REGISTRY.query(
    sql_with("so", "ar", body=f"""
        SELECT s.order_id, s.customer_name, CAST(s.sales AS DOUBLE) AS expected_revenue,
               CAST(a.invoice_amount AS DOUBLE) AS booked_revenue, CAST(abs(s.sales - a.invoice_amount) AS DOUBLE) AS diff
        FROM so s JOIN ar a ON s.order_id = a.order_id
        WHERE s.order_status NOT IN {STRICT} AND a.payment_status <> 'Cancelled' AND abs(s.sales - a.invoice_amount) > 0.01""")
)
def recon_amount_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    return recon.amount_mismatch(_orders(spark, folder), bindings.accounts_receivable(spark, folder))


_LEDGER = """
    feed AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS transaction_id,
                    CASE WHEN l_orderkey % 19 = 0 THEN 'X' || l_orderkey ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
                    CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN l_linenumber % 5 = 0 THEN CAST(1 AS DECIMAL(18,2))
                         WHEN l_linenumber % 7 = 0 THEN CAST(0.01 AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS DECIMAL(18,2)) AS amount
             FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    matched AS (SELECT transaction_id, so.order_id, so.sales, feed.amount, abs(feed.amount - so.sales) < 0.01 AS ok
                FROM feed JOIN so ON so.order_id = feed.order_id)"""


def _with_feed(body: str) -> str:
    return sql_with("so", body="").rstrip() + "," + _LEDGER + body


@REGISTRY.query(
    _with_feed("""
    SELECT transaction_id, order_id, CAST(sales AS DOUBLE) AS ops_amount, CAST(amount AS DOUBLE) AS fin_amount,
           CASE WHEN ok THEN 'MATCHED' ELSE 'MISMATCH' END AS match_status, CASE WHEN ok THEN 'INFO' ELSE 'WARNING' END AS severity,
           'Order ' || order_id || ': ' || CASE WHEN ok THEN 'MATCHED' ELSE 'MISMATCH' END || ' (Ops: ' || sales || ', Fin: ' || amount || ')' AS description
    FROM matched""")
)
def recon_match_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return recon.match_ledger(_orders(spark, folder, customer=False), bindings.ledger_feed(spark, folder), "order_date")


@REGISTRY.query(
    _with_feed("""
    SELECT (SELECT COUNT(*) FROM so) AS total_orders, COUNT(*) FILTER (ok) AS matched, COUNT(*) FILTER (NOT ok) AS mismatched,
           round_even(COUNT(*) FILTER (ok) / CAST((SELECT COUNT(*) FROM so) AS DOUBLE) * 100, 1) AS match_rate
    FROM matched""")
)
def recon_match_summary(spark: SparkSession, folder: str) -> DataFrame:
    orders = _orders(spark, folder, customer=False)
    return recon.match_summary(orders, recon.match_ledger(orders, bindings.ledger_feed(spark, folder)))


@REGISTRY.query(
    sql_with("so", "ar", body=f"""
        SELECT ops.order_id, CAST(ops.order_date AS VARCHAR) AS order_date, CAST(ops.sales AS DOUBLE) AS expected_revenue, ops.customer_name,
               CAST(fin.invoice_amount AS DOUBLE) AS booked_revenue,
               CASE WHEN fin.order_id IS NULL THEN 'MISSING_IN_FINANCE' ELSE 'AMOUNT_MISMATCH' END AS reconciliation_status
        FROM so ops LEFT JOIN ar fin ON ops.order_id = fin.order_id
        WHERE ops.order_status NOT IN {STRICT} AND (fin.order_id IS NULL OR abs(ops.sales - fin.invoice_amount) > 0.01)
        ORDER BY ops.order_date DESC, ops.order_id""")
)
def recon_exceptions(spark: SparkSession, folder: str) -> DataFrame:
    return recon.exceptions(_orders(spark, folder), bindings.accounts_receivable(spark, folder))


@REGISTRY.query(
    sql_with("compared", body="""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(invoice_date AS VARCHAR) AS invoice_date, customer_name,
               CAST(sales AS DOUBLE) AS sales, CAST(invoice_amount AS DOUBLE) AS invoice_amount, in_ops, in_fin, active, live,
               CAST(amount_diff AS DOUBLE) AS amount_diff, days_apart, status FROM compared""")
)
def recon_full(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(spark, folder, customer=True)


@REGISTRY.query(
    sql_with("compared", body="""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(invoice_date AS VARCHAR) AS invoice_date, in_ops, in_fin,
               CAST(sales AS DOUBLE) AS sales, CAST(invoice_amount AS DOUBLE) AS invoice_amount, status
        FROM compared
        WHERE CASE WHEN in_ops THEN order_date ELSE invoice_date END BETWEEN DATE '1998-03-01' AND DATE '1998-03-31'""")
)
def recon_period(spark: SparkSession, folder: str) -> DataFrame:
    """One month, cut on both sides: ghosts by their own date."""
    orders, invoices = _orders(spark, folder, customer=False), bindings.accounts_receivable(spark, folder)
    compared = recon.full(*full_audit.period_sides(orders, invoices, *dates.period_bounds(1998, 3)))
    return compared.select("order_id", "order_date", "invoice_date", "in_ops", "in_fin", "sales", "invoice_amount", "status")


@REGISTRY.query(
    sql_with("so", "ar", body=f"""
        SELECT s.order_id, CAST(s.order_date AS VARCHAR) AS order_date, CAST(a.invoice_date AS VARCHAR) AS invoice_date,
               CAST(a.invoice_date - s.order_date AS INTEGER) AS days_apart
        FROM so s JOIN ar a ON s.order_id = a.order_id
        WHERE s.order_status NOT IN {STRICT} AND a.payment_status <> 'Cancelled' AND abs(a.invoice_date - s.order_date) > 1""")
)
def recon_date_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    return recon.date_mismatch(_orders(spark, folder, customer=False), bindings.accounts_receivable(spark, folder))


@REGISTRY.query(
    sql_with("so", "sl", "ar", body=f"""
        SELECT COUNT(*) AS leaked_orders, CAST(COALESCE(SUM(sales), 0) AS DOUBLE) AS leaked_sales FROM so
        WHERE order_status NOT IN {BASIC}
          AND order_id IN (SELECT order_id FROM sl WHERE shipping_date BETWEEN DATE '1998-04-01' AND DATE '1998-06-30')
          AND order_id NOT IN (SELECT order_id FROM ar)""")
)
def recon_leakage(spark: SparkSession, folder: str) -> DataFrame:
    return recon.leakage(
        _orders(spark, folder, customer=False),
        bindings.shipping_logs(spark, folder),
        bindings.accounts_receivable(spark, folder),
        "1998-04-01",
        "1998-06-30",
    )


@REGISTRY.query(
    sql_with("compared", body="""
        SELECT COUNT(*) FILTER (active) AS ops_orders, COUNT(*) FILTER (live) AS fin_records,
               COUNT(*) FILTER (active AND live) AS key_matched, COUNT(*) FILTER (status = 'OK') AS fully_matched,
               COUNT(*) FILTER (status = 'OPS_ONLY') AS missing_in_fin, COUNT(*) FILTER (status = 'FIN_ONLY') AS ghost_invoices,
               COUNT(*) FILTER (active AND live AND amount_diff > 0.01) AS amount_mismatched,
               COUNT(*) FILTER (status = 'DATE_MISMATCH') AS date_mismatched
        FROM compared""")
)
def recon_summary(spark: SparkSession, folder: str) -> DataFrame:
    return recon.summary(_compared(spark, folder))


@REGISTRY.query(
    sql_with("compared", body=f"""
        SELECT sha256('{AS_OF}|all|scheduler') AS audit_id, '{AS_OF}' AS audit_date, 'all' AS reconciliation_period,
               COUNT(*) FILTER (in_ops) AS total_ops_records, COUNT(*) FILTER (in_fin) AS total_fin_records,
               COUNT(*) FILTER (status = 'OK') AS matched_records, COUNT(*) FILTER (status = 'OPS_ONLY') AS orphan_ops_count,
               COUNT(*) FILTER (status = 'FIN_ONLY') AS orphan_fin_count,
               COUNT(*) FILTER (status = 'AMOUNT_MISMATCH') AS amount_mismatch_count, 'scheduler' AS executed_by,
               'COMPLETED' AS execution_status, 'nightly' AS notes
        FROM compared""")
)
def recon_audit_row(spark: SparkSession, folder: str) -> DataFrame:
    return recon.audit_row(_compared(spark, folder), AS_OF, notes="nightly")


@REGISTRY.query(
    sql_with("compared", body="""
        SELECT COUNT(*) FILTER (active) AS total_ops_orders, COUNT(*) FILTER (in_fin) AS total_fin_records,
               COUNT(*) FILTER (active AND live) AS matched_count,
               round_even(COUNT(*) FILTER (active AND live) / CAST(COUNT(*) FILTER (active) AS DOUBLE) * 100, 2) AS match_rate,
               COUNT(*) FILTER (status = 'OPS_ONLY') AS ops_orphan_count, COUNT(*) FILTER (status = 'FIN_ONLY') AS fin_orphan_count,
               round_even(COUNT(*) FILTER (status IN ('OPS_ONLY', 'FIN_ONLY')) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS orphan_rate,
               COUNT(*) FILTER (status = 'AMOUNT_MISMATCH') AS amount_mismatch_count,
               CAST(COALESCE(SUM(amount_diff) FILTER (status = 'AMOUNT_MISMATCH'), 0) AS DOUBLE) AS amount_mismatch_total,
               COUNT(*) FILTER (status = 'DATE_MISMATCH') AS date_mismatch_count,
               COUNT(*) FILTER (status = 'OPS_ONLY' OR (status = 'OK' AND days_apart <> 0)) AS auto_resolved,
               COUNT(*) FILTER (status IN ('FIN_ONLY', 'DATE_MISMATCH')) AS pending_review,
               COUNT(*) FILTER (status = 'AMOUNT_MISMATCH') AS confirmed_anomaly
        FROM compared""")
)
def recon_control_report(spark: SparkSession, folder: str) -> DataFrame:
    return recon.control_report(_compared(spark, folder))


@REGISTRY.query(
    sql_with("compared", body="""
        SELECT order_id, status,
               CASE status WHEN 'OPS_ONLY' THEN 'AUTO_DRAFT_AR' WHEN 'AMOUNT_MISMATCH' THEN 'DIFFERENCE_ANALYSIS'
                           WHEN 'OK' THEN 'ACCEPT_WITHIN_TOLERANCE' ELSE 'MANUAL_REVIEW' END AS handling,
               CAST(amount_diff AS DOUBLE) AS amount_diff, days_apart
        FROM compared
        WHERE status IN ('OPS_ONLY', 'FIN_ONLY', 'AMOUNT_MISMATCH', 'DATE_MISMATCH') OR (status = 'OK' AND days_apart <> 0)""")
)
def recon_handling(spark: SparkSession, folder: str) -> DataFrame:
    return recon.handling(_compared(spark, folder))


@REGISTRY.query(
    sql_with("so", "ar", body=f"""
        SELECT sha256('AR|' || order_id) AS ar_id, order_id, customer_id, customer_name, CAST(order_date AS VARCHAR) AS invoice_date,
               CAST(order_date + 30 AS VARCHAR) AS due_date, CAST(sales AS DOUBLE) AS invoice_amount, CAST(0 AS DOUBLE) AS paid_amount,
               CAST(sales AS DOUBLE) AS outstanding_amount, 'Outstanding' AS payment_status, 0 AS days_past_due
        FROM so WHERE order_status NOT IN {STRICT} AND order_id NOT IN (SELECT order_id FROM ar)""")
)
def recon_draft_ar(spark: SparkSession, folder: str) -> DataFrame:
    drafts = recon.draft_ar(_orders(spark, folder), bindings.accounts_receivable(spark, folder))
    return drafts.drop("created_at", "updated_at")


def _kept(spark: SparkSession, folder: str, customer: bool = False) -> Comparison:
    """A comparison after three change sets: rows of both sides that lack, or have outdated, a part; then the
    rest and corrections; then deletes and what comes too late to count."""
    orders, invoices = _orders(spark, folder, customer), bindings.accounts_receivable(spark, folder)
    key = F.col("order_id").cast("long")

    def shape(df: DataFrame, seq: int, gone: bool = False) -> DataFrame:
        return df.withColumns({"seq": F.lit(seq), "gone": F.lit(gone)})

    def off(df: DataFrame, column: str) -> DataFrame:
        return df.withColumn(column, (F.col(column) + 1).cast(df.schema[column].dataType))

    def other(df: DataFrame, where: Column) -> DataFrame:
        return df.where(where).withColumn("order_id", F.concat(F.lit("X"), "order_id"))

    extra_order, extra_invoice, late = other(orders, key % 13 == 0), other(invoices, key % 26 == 0), key % 7 == 0
    sets = [
        (shape(off(orders.where(key % 5 == 0), "sales"), 0).unionByName(shape(orders.where((key % 5 != 0) & (key % 3 != 0)), 0)).unionByName(shape(extra_order, 0)),
         shape(invoices.where(key % 4 != 0), 0).unionByName(shape(extra_invoice, 0))),
        (shape(orders.where((key % 5 == 0) | (key % 3 == 0)), 2), shape(off(invoices.where(key % 4 == 0), "invoice_amount"), 1)),
        (shape(off(orders.where(late), "sales"), -1).unionByName(shape(extra_order, 3, True)),
         shape(invoices.where(key % 4 == 0), 3).unionByName(shape(extra_invoice, 3, True))),
    ]
    kept = Comparison(spark, f"{work_dir(spark)}/comparison-{uuid.uuid4().hex}", buckets=16)
    for number, (ops, fin) in enumerate(sets):
        kept.apply(ops, fin, number, gone=F.col("gone"))
    return kept


@REGISTRY.query(
    sql_with("compared", body="""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(invoice_date AS VARCHAR) AS invoice_date, customer_name,
               CAST(sales AS DOUBLE) AS sales, CAST(invoice_amount AS DOUBLE) AS invoice_amount, in_ops, in_fin, active, live,
               CAST(amount_diff AS DOUBLE) AS amount_diff, days_apart, status FROM compared""")
)
def recon_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """The kept comparison after three change sets, out of order and with deletes."""
    return _kept(spark, folder, customer=True).read()


@REGISTRY.query(
    sql_with("compared", body="""
        SELECT COUNT(*) FILTER (active) AS total_ops_orders, COUNT(*) FILTER (in_fin) AS total_fin_records,
               COUNT(*) FILTER (active AND live) AS matched_count,
               round_even(COUNT(*) FILTER (active AND live) / CAST(COUNT(*) FILTER (active) AS DOUBLE) * 100, 2) AS match_rate,
               COUNT(*) FILTER (status = 'OPS_ONLY') AS ops_orphan_count, COUNT(*) FILTER (status = 'FIN_ONLY') AS fin_orphan_count,
               round_even(COUNT(*) FILTER (status IN ('OPS_ONLY', 'FIN_ONLY')) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS orphan_rate,
               COUNT(*) FILTER (status = 'AMOUNT_MISMATCH') AS amount_mismatch_count,
               CAST(COALESCE(SUM(amount_diff) FILTER (status = 'AMOUNT_MISMATCH'), 0) AS DOUBLE) AS amount_mismatch_total,
               COUNT(*) FILTER (status = 'DATE_MISMATCH') AS date_mismatch_count,
               COUNT(*) FILTER (status = 'OPS_ONLY' OR (status = 'OK' AND days_apart <> 0)) AS auto_resolved,
               COUNT(*) FILTER (status IN ('FIN_ONLY', 'DATE_MISMATCH')) AS pending_review,
               COUNT(*) FILTER (status = 'AMOUNT_MISMATCH') AS confirmed_anomaly
        FROM compared""")
)
def recon_incremental_report(spark: SparkSession, folder: str) -> DataFrame:
    """The control report from figures that moved with the changes."""
    return _kept(spark, folder).control_report()
