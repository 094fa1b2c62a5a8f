"""Profiles, key checks, control limits and monitors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import Registry, sql_with
from tallywright.operators import ingest, quality, recon
from tallywright.sources import bindings

REGISTRY = Registry()


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.sales_orders(spark, folder, customer=False, profit=False)


def _compared(spark: SparkSession, folder: str, customer: bool = False) -> DataFrame:
    orders = bindings.sales_orders(spark, folder, customer=customer, profit=False)
    return recon.full(orders, bindings.accounts_receivable(spark, folder))


_PROFILED = (
    "order_id", "order_date", "invoice_date", "customer_name", "sales", "invoice_amount", "in_ops", "in_fin", "active", "live", "amount_diff", "days_apart", "status",
)


@REGISTRY.query(
    sql_with("compared", body="SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS missing_count, round_even((COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE) * 100, 2) AS missing_pct FROM compared"
        for c in _PROFILED
    )
    + ") WHERE missing_count > 0")
)
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.null_profile(_compared(spark, folder, customer=True))


# Every eleventh order's lines twice as they are and a third time with another tax.
_COPIED = """
    WITH copied AS (
        SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 11 = 0
        UNION ALL SELECT * REPLACE (l_tax + 1 AS l_tax) FROM lineitem WHERE l_orderkey % 11 = 0)"""


def _copied(spark: SparkSession, folder: str) -> DataFrame:
    lines = bindings.table(spark, folder, "lineitem")
    again = F.array_repeat(F.lit(0.0), F.when(F.col("l_orderkey") % 11 == 0, 2).otherwise(1))
    more = F.when(F.col("l_orderkey") % 11 == 0, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>"))
    return lines.withColumn("_more", F.explode(F.concat(again, more))).withColumn("l_tax", F.col("l_tax") + F.col("_more")).drop("_more")


@REGISTRY.query(_COPIED + "SELECT DISTINCT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate) FROM copied")
def dedupe_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.dedupe(_copied(spark, folder))


@REGISTRY.query(
    _COPIED + """
    SELECT COUNT(*) AS rows_before, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM copied)) AS rows_after,
           COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM copied)) AS rows_removed
    FROM copied"""
)
def dedupe_summary(spark: SparkSession, folder: str) -> DataFrame:
    return quality.dedupe_summary(_copied(spark, folder))


@REGISTRY.query("SELECT COUNT(*) AS row_count, 11 AS column_count FROM lineitem")
def table_shape(spark: SparkSession, folder: str) -> DataFrame:
    return quality.shape(bindings.table(spark, folder, "lineitem"))


@REGISTRY.query(
    "SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"
)
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(bindings.table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@REGISTRY.query(
    sql_with("so", "sl", body="""
        SELECT order_id, COUNT(*) AS child_rows FROM sl
        WHERE order_id NOT IN (SELECT order_id FROM so WHERE order_status = 'COMPLETE') GROUP BY order_id""")
)
def orphan_fk(spark: SparkSession, folder: str) -> DataFrame:
    """Shipments whose order is not among the completed ones."""
    completed = _orders(spark, folder).where(F.col("order_status") == "COMPLETE")
    return quality.orphan_fk(bindings.shipping_logs(spark, folder), completed, "order_id")


@REGISTRY.query(
    sql_with("so", "ar", body="""
        SELECT (SELECT COUNT(*) FROM so) AS left_rows, COUNT(*) AS joined_rows, COUNT(DISTINCT so.order_id) AS distinct_keys,
               CASE WHEN COUNT(*) = (SELECT COUNT(*) FROM so) THEN 'PASSED' ELSE 'FAILED' END AS integrity
        FROM so LEFT JOIN ar ON so.order_id = ar.order_id""")
)
def left_join_integrity(spark: SparkSession, folder: str) -> DataFrame:
    return quality.left_join_integrity(_orders(spark, folder), bindings.accounts_receivable(spark, folder), "order_id")


@REGISTRY.query(
    sql_with("so", "sl", body="""
        SELECT (SELECT COUNT(*) FROM so) AS left_rows, COUNT(*) AS joined_rows, COUNT(DISTINCT so.order_id) AS distinct_keys,
               CASE WHEN COUNT(*) = (SELECT COUNT(*) FROM so) THEN 'PASSED' ELSE 'FAILED' END AS integrity
        FROM so LEFT JOIN sl ON so.order_id = sl.order_id""")
)
def left_join_fan_out(spark: SparkSession, folder: str) -> DataFrame:
    """The same check on a 1:N join, where it must fail."""
    return quality.left_join_integrity(_orders(spark, folder), bindings.shipping_logs(spark, folder), "order_id")


@REGISTRY.query(
    sql_with("compared", body="""
        , rates AS (
            SELECT 'orphan_rate' AS check_name, COUNT(*) FILTER (status IN ('OPS_ONLY', 'FIN_ONLY')) / CAST(COUNT(*) AS DOUBLE) AS v, 0.001 AS lim, 'max' AS side FROM compared
            UNION ALL SELECT 'amount_diff_rate', CAST(SUM(amount_diff) FILTER (active AND live) AS DOUBLE) / CAST(SUM(sales) FILTER (active AND live) AS DOUBLE), 0.0001, 'max' FROM compared
            UNION ALL SELECT 'date_diff_rate', COUNT(*) FILTER (active AND live AND abs(days_apart) > 1) / CAST(COUNT(*) FILTER (active AND live) AS DOUBLE), 0.01, 'max' FROM compared
            UNION ALL SELECT 'match_rate', COUNT(*) FILTER (status = 'OK') / CAST(COUNT(*) FILTER (active) AS DOUBLE), 0.95, 'min' FROM compared
            UNION ALL SELECT 'unique_key_rate', COUNT(DISTINCT order_id) / CAST(COUNT(*) AS DOUBLE), 1.0, 'min' FROM so)
        SELECT check_name, round_even(v, 6) AS value, CAST(lim AS DOUBLE) AS limit_value,
               CASE WHEN v IS NULL THEN 'NOT_COMPUTABLE' WHEN (side = 'max' AND v <= lim) OR (side = 'min' AND v >= lim) THEN 'PASS' ELSE 'FAIL' END AS verdict
        FROM rates""")
)
def control_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.control_checks(_compared(spark, folder), _orders(spark, folder))


@REGISTRY.query(
    sql_with("compared", body="""
        , k AS (
            SELECT 'completion_rate' AS kpi, COUNT(*) FILTER (active AND live) / CAST(COUNT(*) FILTER (active) AS DOUBLE) AS v FROM compared
            UNION ALL SELECT 'orphan_rate', COUNT(*) FILTER (status IN ('OPS_ONLY', 'FIN_ONLY')) / CAST(COUNT(*) AS DOUBLE) FROM compared
            UNION ALL SELECT 'auto_handled_rate', COUNT(*) FILTER (status = 'OPS_ONLY' OR (status = 'OK' AND days_apart <> 0))
                      / CAST(COUNT(*) FILTER (status IN ('OPS_ONLY', 'FIN_ONLY', 'AMOUNT_MISMATCH', 'DATE_MISMATCH') OR (status = 'OK' AND days_apart <> 0)) AS DOUBLE) FROM compared
            UNION ALL SELECT 'mean_resolution_hours', SUM(event_id % 72) / CAST(COUNT(*) AS DOUBLE) FROM events WHERE event_type = 'error' AND event_id % 4 <> 0)
        SELECT kpi, round_even(v, 4) AS value,
               CASE kpi WHEN 'completion_rate' THEN v < 0.995 WHEN 'orphan_rate' THEN v > 0.005 WHEN 'auto_handled_rate' THEN v < 0.6 ELSE v > 48 END AS alert
        FROM k""")
)
def kpis(spark: SparkSession, folder: str) -> DataFrame:
    return quality.kpis(_compared(spark, folder), bindings.risk_flags(spark, folder))


@REGISTRY.query(
    sql_with("compared", body="""
        SELECT orphans, all_rows, round_even(pct, 4) AS orphan_rate_pct,
               CASE WHEN pct IS NULL THEN 'EMERGENCY' WHEN pct > 1 THEN 'CRITICAL' WHEN pct > 0.5 THEN 'WARNING' WHEN pct > 0.1 THEN 'INFO' ELSE 'NONE' END AS alert_level
        FROM (SELECT COUNT(*) FILTER (status IN ('OPS_ONLY', 'FIN_ONLY')) AS orphans, COUNT(*) AS all_rows,
                     COUNT(*) FILTER (status IN ('OPS_ONLY', 'FIN_ONLY')) * 100.0 / CAST(COUNT(*) AS DOUBLE) AS pct FROM compared)""")
)
def alert_level(spark: SparkSession, folder: str) -> DataFrame:
    return quality.alert_level(_compared(spark, folder))


@REGISTRY.query(
    sql_with("so", "sl", "ar", body="""
        SELECT 'sales_orders' AS table_name, COUNT(*) AS row_count FROM so
        UNION ALL SELECT 'shipping_logs', COUNT(*) FROM sl
        UNION ALL SELECT 'accounts_receivable', COUNT(*) FROM ar
        UNION ALL SELECT 'general_ledger', COUNT(*) + COUNT(*) FILTER (sales - CAST(profit AS DECIMAL(18,2)) > 0) FROM so""")
)
def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = bindings.sales_orders(spark, folder, customer=False)
    booked = orders.withColumn("profit", F.col("profit").cast("decimal(18,2)"))
    return quality.table_counts(
        {
            "sales_orders": _orders(spark, folder),
            "shipping_logs": bindings.shipping_logs(spark, folder),
            "accounts_receivable": bindings.accounts_receivable(spark, folder),
            "general_ledger": ingest.build_general_ledger(booked, seq="order_status"),
        }
    )


@REGISTRY.query(
    sql_with("runs", body="""
        SELECT system, table_name, CAST(run_ts AS VARCHAR) AS run_ts, record_count, prev AS previous_count,
               round_even(abs(record_count - prev) / CAST(prev AS DOUBLE), 4) AS count_change, peak / 20 > 5 AS latency_alert,
               peak / 10 > 10 AS response_alert, COALESCE(abs(record_count - prev) / CAST(prev AS DOUBLE) > 0.2, FALSE) AS count_alert
        FROM (SELECT *, lag(record_count) OVER (PARTITION BY system, table_name ORDER BY run_ts) AS prev FROM runs)""")
)
def sync_monitors(spark: SparkSession, folder: str) -> DataFrame:
    return quality.sync_monitors(bindings.sync_runs(spark, folder))


@REGISTRY.query(
    sql_with("runs", body="""
        SELECT system, COUNT(*) AS runs, COUNT(*) FILTER (peak > 200) AS failures,
               round_even(COUNT(*) FILTER (peak > 200) / CAST(COUNT(*) AS DOUBLE), 4) AS failure_rate,
               COUNT(*) FILTER (peak > 200) / CAST(COUNT(*) AS DOUBLE) > 0.01 AS failure_alert
        FROM runs GROUP BY system""")
)
def sync_failures(spark: SparkSession, folder: str) -> DataFrame:
    return quality.sync_failures(bindings.sync_runs(spark, folder))


@REGISTRY.query(
    """
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, COUNT(*) AS failures
    FROM events WHERE event_type = 'error' GROUP BY date_trunc('hour', ts) HAVING COUNT(*) > 3"""
)
def auth_failures(spark: SparkSession, folder: str) -> DataFrame:
    return quality.auth_failures(bindings.table(spark, folder, "events").where(F.col("event_type") == "error"))


@REGISTRY.query(
    sql_with("compared", body="""
        , days AS (SELECT COALESCE(order_date, invoice_date) AS run_date, COUNT(*) FILTER (status = 'OPS_ONLY') AS ops, COUNT(*) FILTER (status = 'FIN_ONLY') AS fin FROM compared GROUP BY 1),
        sides AS (SELECT 'OPS_ONLY' AS side, run_date, ops AS orphans FROM days UNION ALL SELECT 'FIN_ONLY', run_date, fin FROM days),
        seen AS (SELECT *, lag(orphans) OVER w AS previous_orphans, COUNT(*) OVER e AS n, CAST(SUM(orphans) OVER e AS HUGEINT) AS s, CAST(SUM(orphans * orphans) OVER e AS HUGEINT) AS q
                 FROM sides WINDOW w AS (PARTITION BY side ORDER BY run_date), e AS (PARTITION BY side ORDER BY run_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
        SELECT side, CAST(run_date AS VARCHAR) AS run_date, orphans, previous_orphans, n AS earlier_runs, round_even(CAST(s AS DOUBLE) / n, 4) AS earlier_mean,
               n >= 5 AND COALESCE(n * orphans > s AND (n * orphans - s) * (n * orphans - s) > 9 * (n * q - s * s), FALSE) AS surge
        FROM seen""")
)
def orphan_surge(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans of each day against those of all earlier days."""
    return quality.orphan_surge(quality.orphan_runs(_compared(spark, folder)))
