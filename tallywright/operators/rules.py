"""Audit and fraud rules."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from tallywright.functions import bands, dates, money
from tallywright.operators import filters, joins, windows


@dataclass(frozen=True)
class Rule:
    id: str
    severity: str
    text: str


# Rule ids, levels and texts written to the log.
RULES = {
    rule.id: rule
    for rule in (
        Rule("RECON_MISSING_AR", "HIGH", "Order shipped but not booked in AR"),
        Rule("RECON_AMOUNT_MISMATCH", "MEDIUM", "Sales amount differs from AR amount"),
        Rule("SC_TIMING_FRAUD", "CRITICAL", "Shipping Date < Order Date"),
        Rule("SC_NEGATIVE_MARGIN", "MEDIUM", "Profit < 0 on active order"),
    )
}
ZSCORE_LIMIT = 3.0
DAILY_ORDER_LIMIT = 10


def orders_shipping(orders: DataFrame, shipments: DataFrame, preset: str = "basic", line: Iterable[str] = ("log_id",)) -> DataFrame:
    """Active orders with each of their shipment lines (1:N); ``line`` names the columns that tell lines apart.

    One order may own a large share of the lines; see :func:`joins.join_to_unique` for what that means.
    """
    ops = filters.active_orders(orders, preset).select(
        "order_id", "order_date", "profit", "sales", "order_status", "customer_name"
    )
    lines = shipments.select("order_id", *line, "shipping_date")
    return joins.join_to_unique(lines, ops, "order_id")


def timing(order_lines: DataFrame) -> DataFrame:
    """Lines shipped before they were ordered."""
    gap = dates.days_between(F.col("shipping_date"), F.col("order_date"))
    return (
        order_lines.where(F.col("shipping_date") < F.col("order_date"))
        .withColumn("days_early", -gap)
        .withColumn("severity", bands.severity(gap, bands.TIMING_BANDS))
    )


def negative_margin(df: DataFrame, status: str | None = None) -> DataFrame:
    """Rows sold at a loss; ``status`` narrows them to one order status."""
    losing = df.where(F.col("profit") < 0)
    if status is not None:
        losing = losing.where(F.col("order_status") == status)
    return losing.withColumn("severity", bands.severity(F.col("profit"), bands.MARGIN_BANDS))


def total_loss(losing: DataFrame) -> DataFrame:
    """Rows, distinct orders and summed loss of :func:`negative_margin`."""
    return losing.agg(
        F.count("*").alias("loss_rows"),
        F.count_distinct("order_id").alias("loss_orders"),
        F.abs(F.coalesce(F.sum("profit"), F.lit(Decimal(0)))).alias("total_loss"),
    )


def worst_margins(df: DataFrame, n: int = 3) -> DataFrame:
    """The n lowest profits with their guarded margin; ties by order id."""
    losing = df.where(F.col("profit") < 0)
    worst = windows.top(losing, n, F.asc("profit"), F.asc("order_id"))
    return worst.select(
        "order_id",
        "sales",
        "profit",
        F.bround(money.margin_pct_guarded(F.col("profit"), F.col("sales")), 1).alias("margin_pct"),
    )


def lowest_margin_orders(orders: DataFrame, n: int = 20, preset: str = "canceled_only") -> DataFrame:
    """The n lowest-profit losing orders in scope with their plain margin."""
    losing = filters.active_orders(orders, preset).where(F.col("profit") < 0)
    worst = windows.top(losing, n, F.asc("profit"), F.asc("order_id"))
    return worst.select(
        "order_id", "sales", "profit", money.margin_pct(F.col("profit"), F.col("sales")).alias("margin_pct")
    )


def examples(findings: DataFrame, n: int = 5) -> DataFrame:
    """First n findings by order id, for a report."""
    return windows.top(findings, n, F.asc("order_id"))


# -- transaction exports ------------------------------------------------------


def _export_rules(export: DataFrame) -> list[tuple[str, Column, Column]]:
    """(type, condition, value) of each export rule, in the order of the report.  Marks of unreadable
    cells come from :func:`tallywright.sources.readers.typed_export`."""
    none = F.lit(None).cast(export.schema["amount"].dataType)
    checks = [("negative_amount", F.col("amount") < 0, F.col("amount")), ("missing_account_code", F.col("account_code").isNull(), none)]
    return checks + [(f"unreadable_{c}", F.col(f"{c}_unreadable"), none) for c in ("amount", "date") if f"{c}_unreadable" in export.columns]


def export_anomalies(export: DataFrame, row: str = "row") -> DataFrame:
    """One line per row and broken rule: a negative amount, a missing account code, an amount or a
    date that does not read."""
    hits = [
        F.when(condition, F.struct(F.lit(k).alias("rule_no"), F.lit(name).alias("type"), value.alias("value")))
        for k, (name, condition, value) in enumerate(_export_rules(export))
    ]
    return export.select(row, "transaction_id", F.explode(F.array_compact(F.array(*hits))).alias("a")).select(
        row, "transaction_id", "a.rule_no", "a.type", "a.value"
    )


def export_summary(export: DataFrame, row: str = "row", shown: int = 10) -> DataFrame:
    """Rows processed, anomalies found and the first ``shown`` of them, one row."""
    anomalies = export_anomalies(export, row)
    first = (
        windows.top(anomalies, shown, F.asc(row), F.asc("rule_no"))
        .agg(F.array_sort(F.collect_list(F.struct(row, "rule_no", "type", "value"))).alias("l"))
        .select(F.transform("l", lambda a: F.struct(a[row].alias(row), a["type"].alias("type"), a["value"].alias("value"))))
    )
    counts = export.agg(
        F.count("*").alias("rows_processed"),
        F.coalesce(F.sum(sum((F.when(hit, 1).otherwise(0) for _, hit, _ in _export_rules(export)), F.lit(0))), F.lit(0))
        .cast("bigint")
        .alias("anomalies_found"),
    )
    return counts.withColumn("anomaly_list", first.scalar())


# -- statistical rules --------------------------------------------------------


def amount_zscore(df: DataFrame, key: str, amount: str, limit: float = ZSCORE_LIMIT) -> DataFrame:
    """Rows whose amount lies more than ``limit`` sample deviations above the mean.

    Mean and deviation come from one map-side combined aggregate and enter the
    scan as a scalar; no window over the whole table.
    """
    value = F.col(amount).cast("double")
    stats = df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("dev"))
    both = stats.select(F.struct("mean", "dev")).scalar()
    scored = df.select(key, amount, F.try_divide(value - both["mean"], both["dev"]).alias("z"))
    return scored.where(F.col("z") > limit).withColumn("severity", bands.severity(F.col("z"), bands.AMOUNT_BANDS))


def order_frequency(
    df: DataFrame, customer: str, day: Column, key: str, limit: int = DAILY_ORDER_LIMIT
) -> DataFrame:
    """Customers with more than ``limit`` orders on one day.

    The distinct count runs in two steps, so a busy customer is pre-aggregated
    by order before its day comes together.
    """
    return (
        df.groupBy(F.col(customer).alias("customer"), day.alias("day"))
        .agg(F.count_distinct(key).alias("orders"))
        .where(F.col("orders") > limit)
        .withColumn("severity", bands.severity(F.col("orders"), bands.FREQUENCY_BANDS))
    )


def severity_counts(order_lines: DataFrame) -> DataFrame:
    """Lines per rule and level over all lines, triggered or not."""
    gap = dates.days_between(F.col("shipping_date"), F.col("order_date"))
    levels = F.array(
        F.struct(F.lit("timing").alias("rule"), bands.severity(gap, bands.TIMING_BANDS).alias("level")),
        F.struct(F.lit("margin").alias("rule"), bands.severity(F.col("profit"), bands.MARGIN_BANDS).alias("level")),
    )
    return (
        order_lines.select(F.explode(levels).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"), F.col("r.level").alias("level"))
        .agg(F.count("*").alias("n"))
    )
