"""Row filters; bounds are literals so they reach the scan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tallywright.functions import dates

# Statuses left out of the scope, per preset.
EXCLUDED_STATUSES = {
    "strict": ("CANCELED", "CANCELLED", "SUSPECTED_FRAUD"),
    "basic": ("CANCELED", "CANCELLED"),
    "canceled_only": ("CANCELED",),
}
DEAD_INVOICE = "Cancelled"


def is_active(preset: str = "strict", keep_null_status: bool = False, column: str = "order_status") -> Column:
    """Predicate for orders in scope; an order without a status is out unless asked for."""
    status = F.col(column)
    inside = ~status.isin(*EXCLUDED_STATUSES[preset])
    return F.coalesce(inside, F.lit(keep_null_status))


def active_orders(df: DataFrame, preset: str = "strict", keep_null_status: bool = False) -> DataFrame:
    inside = ~F.col("order_status").isin(*EXCLUDED_STATUSES[preset])
    return df.where(inside | F.col("order_status").isNull() if keep_null_status else inside)


def live_invoices(df: DataFrame) -> DataFrame:
    return df.where(F.col("payment_status") != DEAD_INVOICE)


def date_range(
    df: DataFrame, start: str | dt.date | None, end: str | dt.date | None, column: str = "order_date"
) -> DataFrame:
    """Inclusive range; both ends or no filter at all.

    Stored orders are partitioned by year, so a range on their date also names the
    years and skips the other folders.
    """
    if start is None or end is None:
        return df
    inside = dates.between_dates(F.col(column), start, end)
    if column == "order_date" and "order_year" in df.columns:
        inside = inside & F.col("order_year").between(int(str(start)[:4]), int(str(end)[:4]))
    return df.where(inside)


def period(df: DataFrame, year: int, month: int | None = None, column: str = "order_date") -> DataFrame:
    """One year or one month, as a range on the raw column."""
    return date_range(df, *dates.period_bounds(year, month), column=column)


def non_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != ""))


def recent(df: DataFrame, column: str, as_of: str | dt.datetime, days: int) -> DataFrame:
    """Rows of the last ``days`` days; the bound takes the column's own type."""
    bound = dates.days_before(as_of, days).cast(df.schema[column].dataType)
    return df.where(F.col(column) >= bound)
