"""Profit and loss reports."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from tallywright.functions import dates, money
from tallywright.operators import filters, windows


def _sums() -> list:
    return [
        F.count("*").alias("order_count"),
        F.sum("sales").alias("revenue"),
        F.sum("profit").alias("net_profit"),
    ]


def monthly_pnl(orders: DataFrame, months: int | None = 6, preset: str = "basic") -> DataFrame:
    """Orders, revenue, profit and margin per month, newest first."""
    dated = filters.active_orders(orders, preset).where(F.col("order_date").isNotNull())
    by_month = dated.groupBy(dates.month_label(F.col("order_date")).alias("month")).agg(*_sums())
    newest = by_month.orderBy(F.desc("month")) if months is None else windows.top(by_month, months, F.desc("month"))
    return newest.withColumn("margin_pct", money.margin_pct(F.col("net_profit"), F.col("revenue")))


def pnl_total(orders: DataFrame, months: int = 6, preset: str = "basic") -> DataFrame:
    """The shown months and a TOTAL row with the margin over them all.

    The total rolls up the few month rows already computed, not the orders again.
    """
    shown = monthly_pnl(orders, months, preset).drop("margin_pct")
    rolled = shown.rollup("month").agg(
        F.coalesce(F.sum("order_count"), F.lit(0)).alias("order_count"),
        F.coalesce(F.sum("revenue"), F.lit(Decimal(0))).alias("revenue"),
        F.coalesce(F.sum("net_profit"), F.lit(Decimal(0))).alias("net_profit"),
    )
    guarded = F.bround(money.margin_pct_guarded(F.col("net_profit"), F.col("revenue")), 2)
    return rolled.select(
        F.coalesce("month", F.lit("TOTAL")).alias("month"),
        "order_count",
        "revenue",
        "net_profit",
        guarded.alias("margin_pct"),
    )


def regional_profit(orders: DataFrame, n: int = 10, preset: str = "basic") -> DataFrame:
    """Most profitable countries."""
    placed = filters.non_blank(filters.active_orders(orders, preset), "customer_country")
    by_region = placed.groupBy(F.col("customer_country").alias("region")).agg(*_sums())
    best = windows.top(by_region, n, F.desc("net_profit"), F.asc("region"))
    return best.withColumn("margin_pct", money.margin_pct(F.col("net_profit"), F.col("revenue")))


def period_close(orders: DataFrame, year: int, month: int | None = None, preset: str = "basic") -> DataFrame:
    """Close of one month or year per order status: orders, revenue, profit."""
    closed = filters.period(filters.active_orders(orders, preset), year, month)
    return closed.groupBy("order_status").agg(*_sums())


def newest_orders(orders: DataFrame, n: int = 10) -> DataFrame:
    return windows.top(orders, n, F.desc("order_date"), F.asc("order_id"))
