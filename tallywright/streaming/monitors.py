"""Windowed monitors over event streams.

Counts combine per task before they are shuffled, so one busy user or hour sends
one row per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tallywright.functions import bands
from tallywright.operators.governance import ACCESS_LIMIT
from tallywright.operators.quality import MAX_AUTH_FAILURES_PER_HOUR
from tallywright.operators.rules import DAILY_ORDER_LIMIT

LATENESS = "1 day"


def completed(
    closed: DataFrame,
    events: DataFrame,
    ts: str,
    monitor: Callable[[DataFrame], DataFrame],
    start: Column,
    span: str,
    lateness: str = LATENESS,
) -> DataFrame:
    """The windows a stream has closed and, counted in batch, those still open at its end.

    ``closed`` is the result of ``monitor`` over the stream once it has read all ``events``; ``start``
    is the moment its windows begin and ``span`` their length.  Only rows that can lie in an open window
    are read again.
    """
    mark = events.select(F.max(ts) - F.expr(f"INTERVAL {lateness}")).scalar()
    length = F.expr(f"INTERVAL {span}")
    still_open = monitor(events.where(F.col(ts) >= mark - length)).where(start + length > mark)
    return closed.unionByName(still_open)


def dedupe(events: DataFrame, key: str, ts: str, lateness: str = LATENESS) -> DataFrame:
    """First arrival of each key within the lateness; replays drop out."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])


def auth_failures(
    attempts: DataFrame, ts: str, limit: int = MAX_AUTH_FAILURES_PER_HOUR, lateness: str = LATENESS
) -> DataFrame:
    """Hours with more than ``limit`` failed sign-ins."""
    return (
        attempts.withWatermark(ts, lateness)
        .groupBy(F.window(ts, "1 hour").alias("w"))
        .agg(F.count("*").alias("failures"))
        .where(F.col("failures") > limit)
        .select(F.col("w.start").alias("hour"), "failures")
    )


def access_counts(
    log: DataFrame, ts: str, user: str, kind: str, limit: int = ACCESS_LIMIT, lateness: str = LATENESS
) -> DataFrame:
    """Users above ``limit`` accesses in any day-long window, moved on by the hour.

    Entity kinds are a handful of names, so their set stays small.
    """
    return (
        log.withWatermark(ts, lateness)
        .groupBy(F.window(ts, "1 day", "1 hour").alias("w"), F.col(user).alias("auditor_id"))
        .agg(F.count("*").alias("access_count"), F.size(F.collect_set(kind)).alias("entity_types"))
        .where(F.col("access_count") > limit)
        .select(F.col("w.start").alias("window_start"), "auditor_id", "access_count", "entity_types")
    )


def order_frequency(
    orders: DataFrame, ts: str, customer: str, limit: int = DAILY_ORDER_LIMIT, lateness: str = LATENESS, order: str | None = None
) -> DataFrame:
    """Customers above ``limit`` orders on one UTC day, with their level.

    With ``order``, the id of an order, lines and replays of one order count once: the state keeps the
    distinct ids of a customer's day until the watermark closes the day.
    """
    utc_day = F.date_from_unix_date(F.floor(F.unix_seconds("w.start") / 86_400).cast("int"))
    days = orders.withWatermark(ts, lateness).withColumn("w", F.window(ts, "1 day"))
    if order:
        days = days.dropDuplicates(["w", customer, order])
    return (
        days.groupBy("w", F.col(customer).alias("customer"))
        .agg(F.count("*").alias("orders"))
        .where(F.col("orders") > limit)
        .select(
            utc_day.alias("day"),
            "customer",
            "orders",
            bands.severity(F.col("orders"), bands.FREQUENCY_BANDS).alias("severity"),
        )
    )
