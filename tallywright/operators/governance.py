"""Masked views, log integrity, access checks and retention."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tallywright.functions.hashing import row_digest
from tallywright.functions.text import mask_name
from tallywright.operators import filters

# Columns a read-only user may see, names masked.
MASKED_ORDERS = (
    "order_id", "order_date", "customer_id", "customer_name", "customer_segment", "customer_country",
    "product_id", "category_name", "order_quantity", "sales", "profit", "order_status", "order_priority",
)
MASKED_RECEIVABLES = (
    "ar_id", "order_id", "customer_id", "customer_name", "invoice_date", "due_date", "invoice_amount",
    "paid_amount", "outstanding_amount", "payment_status", "days_past_due",
)

# Years kept per table; tables not named are kept for ever.
RETENTION_YEARS = {"sales_orders": 2, "accounts_receivable": 7, "general_ledger": 10}

ACCESS_LIMIT = 1000


def masked_view(df: DataFrame, columns: tuple[str, ...], name: str = "customer_name") -> DataFrame:
    """The allowed columns, the name cut to its first letter."""
    shown = [mask_name(F.col(c)).alias(f"{name}_masked") if c == name else F.col(c) for c in columns if c in df.columns]
    return df.select(*shown)


def masked_orders(orders: DataFrame) -> DataFrame:
    return masked_view(orders, MASKED_ORDERS)


def masked_receivables(invoices: DataFrame) -> DataFrame:
    return masked_view(invoices, MASKED_RECEIVABLES)


def register_read_views(orders: DataFrame, invoices: DataFrame, log: DataFrame) -> None:
    """Temporary views for read-only users; the log is shown whole."""
    masked_orders(orders).createOrReplaceTempView("ro_sales_orders")
    masked_receivables(invoices).createOrReplaceTempView("ro_accounts_receivable")
    log.createOrReplaceTempView("ro_audit_logs")


def permission_changes(log: DataFrame) -> DataFrame:
    """Log lines about permissions or roles, newest first; the id splits a busy moment."""
    wanted = F.col("action").like("%PERMISSION%") | F.col("action").like("%ROLE%")
    return (
        log.where(wanted)
        .select("log_id", "audit_date", "auditor_id", "action", "entity_type", "entity_id", "notes")
        .orderBy(F.desc("audit_date"), "log_id")
    )


def access_anomaly(log: DataFrame, as_of: str | dt.datetime, limit: int = ACCESS_LIMIT, days: int = 1) -> DataFrame:
    """Auditors with more than ``limit`` accesses in the last days and what they touched."""
    return (
        filters.recent(log, "audit_date", as_of, days)
        .groupBy("auditor_id")
        .agg(F.count("*").alias("access_count"), F.count_distinct("entity_type").alias("entity_types"))
        .where(F.col("access_count") > limit)
    )


def with_row_hash(df: DataFrame, columns: list[str] | None = None, out: str = "row_hash") -> DataFrame:
    """Add the digest over the given (default: all) columns."""
    return df.withColumn(out, row_digest(columns or df.columns))


def verify_hashes(df: DataFrame, stored: DataFrame, key: str = "log_id") -> DataFrame:
    """Rows whose digest differs from the stored one, set-wise.

    ``stored``: key and ``row_hash`` as written when the row was logged.
    """
    now = df.select(key, row_digest(df.columns).alias("found_hash"))
    return now.join(stored.select(key, F.col("row_hash").alias("stored_hash")), key).where(
        F.col("found_hash") != F.col("stored_hash")
    )


def append_only_check(before: DataFrame, after: DataFrame, key: str = "log_id") -> DataFrame:
    """Lines of an earlier state that the later one lost or changed; empty when clean.

    Both frames carry the key and ``row_hash``.
    """
    then = before.select(key, F.col("row_hash").alias("old_hash"))
    now = after.select(key, F.col("row_hash").alias("new_hash"))
    kind = F.when(F.col("new_hash").isNull(), "DELETED").when(F.col("new_hash") != F.col("old_hash"), "CHANGED")
    return then.join(now, key, "left").select(key, kind.alias("violation")).where(F.col("violation").isNotNull())


def retention_cutoff(table: str, as_of: str | dt.date) -> dt.date | None:
    """First day still kept, None when the table is kept for ever."""
    years = RETENTION_YEARS.get(table)
    if years is None:
        return None
    day = as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(str(as_of))
    try:
        return day.replace(year=day.year - years)
    except ValueError:  # 29 February
        return day.replace(year=day.year - years, day=28)


def retention(df: DataFrame, table: str, column: str, as_of: str | dt.date) -> tuple[DataFrame, DataFrame]:
    """Rows to keep and rows past their time; undated rows are kept."""
    cutoff = retention_cutoff(table, as_of)
    if cutoff is None:
        return df, df.where(F.lit(False))
    limit = F.lit(cutoff.isoformat()).cast("date")
    kept = df.where((F.col(column) >= limit) | F.col(column).isNull())
    return kept, df.where(F.col(column) < limit)


def retention_summary(df: DataFrame, table: str, column: str, as_of: str | dt.date) -> DataFrame:
    """Rows kept and expired, one row."""
    cutoff = retention_cutoff(table, as_of)
    expired = F.lit(False) if cutoff is None else F.coalesce(F.col(column) < F.lit(cutoff.isoformat()).cast("date"), F.lit(False))
    return df.agg(F.count_if(~expired).alias("kept"), F.count_if(expired).alias("expired")).select(
        F.lit(table).alias("table_name"), "kept", "expired"
    )
