"""The full audit: compare, judge, log, report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywright.functions import dates
from tallywright.operators import audit_log, filters, joins, quality, recon, reports, rules
from tallywright.plans.build_stores import create_audit_tables
from tallywright.session import work_dir
from tallywright.sources import catalog, sinks


@dataclass
class AuditResult:
    compared: DataFrame
    summary: DataFrame
    control_report: DataFrame
    checks: DataFrame
    alert: DataFrame
    findings: DataFrame
    monthly_pnl: DataFrame
    regional_profit: DataFrame
    total_loss: DataFrame
    worst_margins: DataFrame


def _results(orders: DataFrame, shipments: DataFrame, compared: DataFrame, findings: DataFrame) -> AuditResult:
    lines = rules.orders_shipping(orders, shipments)
    return AuditResult(
        compared=compared,
        summary=recon.summary(compared),
        control_report=recon.control_report(compared),
        checks=quality.control_checks(compared, orders),
        alert=quality.alert_level(compared),
        findings=findings,
        monthly_pnl=reports.pnl_total(orders),
        regional_profit=reports.regional_profit(orders),
        total_loss=rules.total_loss(rules.negative_margin(lines)),
        worst_margins=rules.worst_margins(lines),
    )


def audit(orders: DataFrame, invoices: DataFrame, shipments: DataFrame, as_of: str) -> AuditResult:
    """All results as lazy frames; nothing is logged."""
    compared = recon.full(orders, invoices)
    return _results(orders, shipments, compared, audit_log.all_findings(orders, invoices, shipments, as_of))


def period_sides(orders: DataFrame, invoices: DataFrame, first: dt.date, last: dt.date) -> tuple[DataFrame, DataFrame]:
    """Orders and invoices of a period: the orders dated in it, their invoices whatever their date,
    and the invoices dated in it that belong to no order at all."""
    inside = filters.date_range(orders, first, last)
    own = invoices.join(inside.select("order_id"), "order_id", "left_semi")
    ghosts = joins.anti_join(invoices.where(dates.between_dates(F.col("invoice_date"), first, last)), orders, "order_id")
    return inside, own.select(*invoices.columns).unionByName(ghosts)


def run(
    spark: SparkSession, as_of: str, year: int | None = None, month: int | None = None, executed_by: str = "scheduler"
) -> AuditResult:
    """Audit the stored tables (or one period of them) and log what is new.

    For a period both sides are cut (:func:`period_sides`).  The comparison and the
    findings feed several outputs each and are checkpointed once.
    """
    orders = catalog.table(spark, "operations", "sales_orders")
    invoices = catalog.table(spark, "finance", "accounts_receivable")
    shipments = catalog.table(spark, "operations", "shipping_logs")
    label = "all"
    if year is not None:
        first, last = dates.period_bounds(year, month)
        orders, invoices = period_sides(orders, invoices, first, last)
        label = f"{year}" if month is None else f"{year}-{month:02d}"
    create_audit_tables(spark)
    work_dir(spark)
    compared = recon.full(orders, invoices).checkpoint()
    findings = audit_log.all_findings(orders, invoices, shipments, as_of).checkpoint()
    sinks.append_new(findings, "audit.audit_logs", "log_id")
    sinks.append_new(audit_log.to_risk_flags(findings), "audit.risk_flags", "flag_id")
    row = recon.audit_row(compared, as_of, label, executed_by)
    sinks.append_new(row, "audit.reconciliation_audit", "audit_id")
    return _results(orders, shipments, compared, findings)
