"""Findings and the audit log."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tallywright.functions import money
from tallywright.functions.hashing import content_id
from tallywright.operators import recon, rules, windows
from tallywright.schemas import AUDIT_LOGS

SOURCE_SYSTEM = "tallywright"


def to_findings(
    df: DataFrame,
    rule: rules.Rule | str,
    as_of: str,
    entity: str = "order_id",
    line: Column | None = None,
    source_system: str = SOURCE_SYSTEM,
) -> DataFrame:
    """Rows as audit log lines, for one rule or for the rule id in a column.

    The id depends on rule, entity and line only, not on the time of detection,
    so a rerun finds its lines already there.
    """
    if isinstance(rule, rules.Rule):
        rule_id, text, level = F.lit(rule.id), F.lit(rule.text), F.lit(rule.severity)
    else:
        rule_id = F.col(rule)
        text, level = (
            F.try_element_at(F.create_map(*(F.lit(x) for r in rules.RULES.values() for x in (r.id, part(r)))), rule_id)
            for part in (lambda r: r.text, lambda r: r.severity)
        )
    values = {
        "log_id": content_id(rule_id, entity, F.lit("") if line is None else line),
        "audit_date": F.lit(as_of).cast("timestamp"),
        "audit_type": F.lit("Automated"),
        "source_system": F.lit(source_system),
        "entity_type": F.lit("Order"),
        "entity_id": F.col(entity).cast("string"),
        "action": rule_id,
        "notes": text,
        "risk_level": level,
        "status": F.lit("Pending"),
    }
    return df.select(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in AUDIT_LOGS.fields)
    )


def _flag_rows(df: DataFrame, triggers: dict[str, Column]) -> DataFrame:
    """One row per input row and triggered rule, the rule in ``rule_id``."""
    hits = F.array_compact(F.array(*(F.when(hit, F.lit(rule)) for rule, hit in triggers.items())))
    return df.withColumn("rule_id", F.explode(hits))


def all_findings(
    orders: DataFrame,
    invoices: DataFrame,
    shipments: DataFrame,
    as_of: str,
    line: Iterable[str] = ("log_id",),
    line_id: Column | None = None,
) -> DataFrame:
    """Findings of the four rules over one run.

    Two joins serve the four rules: orders with invoices, orders with shipments.  Where ``line_id`` is made
    of the columns ``line`` of the shipments, these are joined and only findings get the id.
    """
    booked = _flag_rows(
        recon.reconcile(orders, invoices),
        {
            "RECON_MISSING_AR": F.col("match_state") == "left_only",
            "RECON_AMOUNT_MISMATCH": (F.col("match_state") == "both") & (F.col("diff") > money.AMOUNT_TOLERANCE),
        },
    )
    shipped = _flag_rows(
        rules.orders_shipping(orders, shipments, line=line),
        {
            "SC_TIMING_FRAUD": F.col("shipping_date") < F.col("order_date"),
            "SC_NEGATIVE_MARGIN": F.col("profit") < 0,
        },
    )
    return to_findings(booked, "rule_id", as_of).unionByName(
        to_findings(shipped, "rule_id", as_of, line=F.col("log_id") if line_id is None else line_id)
    )


def not_yet_logged(findings: DataFrame, log: DataFrame) -> DataFrame:
    """Findings whose id the log does not hold; ids are hashes, so no key is hot."""
    return findings.dropDuplicates(["log_id"]).join(log.select("log_id"), "log_id", "left_anti")


def by_level(log: DataFrame) -> DataFrame:
    return log.groupBy("risk_level").agg(F.count("*").alias("n"))


def latest(log: DataFrame, n: int = 20) -> DataFrame:
    """Newest n log lines."""
    return windows.top(log, n, F.desc("audit_date"), F.asc("log_id")).select(
        "log_id", "audit_date", F.col("entity_id").alias("order_id"), F.col("action").alias("risk_type"), "risk_level", "notes"
    )


def to_risk_flags(findings: DataFrame) -> DataFrame:
    """One open flag per order and rule, however many lines triggered it, at the gravest level."""
    gravity = F.array_position(F.array(*[F.lit(level) for level in ("LOW", "MEDIUM", "HIGH", "CRITICAL")]), F.col("risk_level"))
    return (
        findings.groupBy("entity_type", "entity_id", "action", "source_system")
        .agg(
            F.max(F.struct(gravity, "risk_level"))["risk_level"].alias("severity"),
            F.max("notes").alias("description"),
            F.max("audit_date").alias("flag_date"),
        )
        .select(
            content_id(F.lit("FLAG"), "action", "entity_id").alias("flag_id"),
            "flag_date",
            F.col("action").alias("risk_type"),
            "severity",
            "entity_type",
            "entity_id",
            "description",
            "source_system",
            F.lit("Open").alias("status"),
            F.lit(None).cast("string").alias("assigned_to"),
            F.lit(None).cast("string").alias("resolution_notes"),
            F.lit(None).cast("timestamp").alias("resolved_at"),
            F.col("flag_date").alias("created_at"),
        )
    )
