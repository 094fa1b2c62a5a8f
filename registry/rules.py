"""Audit and fraud rules and their scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import BASIC, STRICT, Registry, sql_with
from tallywright.functions import bands
from tallywright.operators import filters, metrics, recon, rules
from tallywright.sources import bindings

REGISTRY = Registry()


def _orders(spark: SparkSession, folder: str, customer: bool = False) -> DataFrame:
    return bindings.sales_orders(spark, folder, customer=customer)


def _lines(spark: SparkSession, folder: str, customer: bool = False) -> DataFrame:
    return rules.orders_shipping(_orders(spark, folder, customer), bindings.shipping_logs(spark, folder))


_LINE_COLUMNS = """order_id, log_id, CAST(shipping_date AS VARCHAR) AS shipping_date, CAST(order_date AS VARCHAR) AS order_date,
               CAST(profit AS DOUBLE) AS profit, CAST(sales AS DOUBLE) AS sales, order_status, customer_name"""


@REGISTRY.query(sql_with("order_lines", body=f"SELECT {_LINE_COLUMNS} FROM order_lines"))
def orders_shipping(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, customer=True)


@REGISTRY.query(
    sql_with("order_lines", body=f"""
        SELECT {_LINE_COLUMNS}, CAST(-gap AS INTEGER) AS days_early, 'CRITICAL' AS severity
        FROM order_lines WHERE shipping_date < order_date""")
)
def rule_timing(spark: SparkSession, folder: str) -> DataFrame:
    return rules.timing(_lines(spark, folder, customer=True))


@REGISTRY.query(
    sql_with("order_lines", body=f"""
        SELECT {_LINE_COLUMNS},
               CASE WHEN profit < -1000 THEN 'CRITICAL' WHEN profit < -500 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
        FROM order_lines WHERE profit < 0""")
)
def rule_negative_margin(spark: SparkSession, folder: str) -> DataFrame:
    return rules.negative_margin(_lines(spark, folder, customer=True))


@REGISTRY.query(
    sql_with("so", body="""
        SELECT order_id, CAST(profit AS DOUBLE) AS profit, CAST(sales AS DOUBLE) AS sales,
               CASE WHEN profit < -1000 THEN 'CRITICAL' WHEN profit < -500 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
        FROM so WHERE profit < 0 AND order_status = 'COMPLETE'""")
)
def rule_negative_margin_complete(spark: SparkSession, folder: str) -> DataFrame:
    """The rule over completed orders only, one row per order."""
    losing = rules.negative_margin(_orders(spark, folder), status="COMPLETE")
    return losing.select("order_id", "profit", "sales", "severity")


@REGISTRY.query(
    sql_with("order_lines", body="""
        SELECT COUNT(*) AS loss_rows, COUNT(DISTINCT order_id) AS loss_orders, CAST(abs(COALESCE(SUM(profit), 0)) AS DOUBLE) AS total_loss
        FROM order_lines WHERE profit < 0""")
)
def rule_total_loss(spark: SparkSession, folder: str) -> DataFrame:
    return rules.total_loss(rules.negative_margin(_lines(spark, folder)))


@REGISTRY.query(
    sql_with("so", body=f"""
        SELECT order_id, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit,
               round_even(CASE WHEN sales > 0 THEN CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE) * 100 ELSE 0 END, 1) AS margin_pct
        FROM so WHERE profit < 0 AND order_status NOT IN {BASIC} ORDER BY so.profit, order_id LIMIT 3""")
)
def rule_worst_margins(spark: SparkSession, folder: str) -> DataFrame:
    return rules.worst_margins(filters.active_orders(_orders(spark, folder), "basic"))


@REGISTRY.query(
    sql_with("so", body="""
        SELECT order_id, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit,
               round_even(CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE) * 100, 2) AS margin_pct
        FROM so WHERE so.profit < 0 AND order_status NOT IN ('CANCELED') ORDER BY so.profit, order_id LIMIT 20""")
)
def rule_margin_pct(spark: SparkSession, folder: str) -> DataFrame:
    return rules.lowest_margin_orders(_orders(spark, folder))


@REGISTRY.query(
    sql_with("so", "ar", body=f"""
        SELECT order_id, order_status, CAST(sales AS DOUBLE) AS expected_revenue, customer_name FROM so
        WHERE order_status NOT IN {STRICT}
          AND NOT EXISTS (SELECT 1 FROM ar WHERE ar.order_id = so.order_id AND payment_status <> 'Cancelled')
        ORDER BY order_id LIMIT 5""")
)
def rule_examples(spark: SparkSession, folder: str) -> DataFrame:
    """First five findings, as a report shows them."""
    orders = bindings.sales_orders(spark, folder, profit=False)
    return rules.examples(recon.missing_ar(orders, bindings.accounts_receivable(spark, folder)), 5)


_EXPORT = """
    WITH feed AS (SELECT o_orderkey AS row, 'TXN' || o_orderkey AS transaction_id,
                         CAST(CASE WHEN o_orderkey % 31 = 0 THEN -CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) AS amount,
                         CASE WHEN o_orderkey % 41 <> 0 THEN CASE WHEN o_orderstatus = 'P' THEN '2000' ELSE '1000' END END AS account_code
                  FROM orders),
    found AS (SELECT row, transaction_id, 0 AS rule_no, 'negative_amount' AS type, amount AS value FROM feed WHERE amount < 0
              UNION ALL SELECT row, transaction_id, 1, 'missing_account_code', NULL FROM feed WHERE account_code IS NULL)"""


@REGISTRY.query(_EXPORT + " SELECT row, transaction_id, rule_no, type, value FROM found")
def rule_export_anomalies(spark: SparkSession, folder: str) -> DataFrame:
    return rules.export_anomalies(bindings.export_feed(spark, folder))


@REGISTRY.query(
    _EXPORT + """
    SELECT (SELECT COUNT(*) FROM feed) AS rows_processed, (SELECT COUNT(*) FROM found) AS anomalies_found,
           (SELECT string_agg(row || ':' || type, ',' ORDER BY row, rule_no)
            FROM (SELECT * FROM found ORDER BY row, rule_no LIMIT 10)) AS anomaly_list"""
)
def rule_export_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = rules.export_summary(bindings.export_feed(spark, folder))
    shown = F.transform("anomaly_list", lambda a: F.concat_ws(":", a["row"].cast("string"), a["type"]))
    return summary.withColumn("anomaly_list", F.array_join(shown, ","))


@REGISTRY.query(
    """
    SELECT event_id, value, round_even(z, 6) AS z,
           CASE WHEN z >= 5 THEN 'CRITICAL' WHEN z >= 4 THEN 'HIGH' ELSE 'MEDIUM' END AS severity
    FROM (SELECT event_id, value, (value - (SELECT AVG(value) FROM events)) / (SELECT stddev_samp(value) FROM events) AS z FROM events)
    WHERE z > 3"""
)
def rule_amount_zscore(spark: SparkSession, folder: str) -> DataFrame:
    scored = rules.amount_zscore(bindings.table(spark, folder, "events"), "event_id", "value")
    return scored.withColumn("z", F.bround("z", 6))


@REGISTRY.query(
    """
    SELECT user_id AS customer, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, COUNT(DISTINCT event_id) AS orders, 'LOW' AS severity
    FROM events GROUP BY user_id, CAST(ts AS DATE) HAVING COUNT(DISTINCT event_id) > 5"""
)
def rule_order_frequency(spark: SparkSession, folder: str) -> DataFrame:
    events = bindings.table(spark, folder, "events")
    return rules.order_frequency(events, "user_id", F.to_date("ts"), "event_id", limit=5)


@REGISTRY.query(
    sql_with("order_lines", body="""
        SELECT 'timing' AS rule, CASE WHEN gap < 0 THEN 'CRITICAL' WHEN gap < 1 THEN 'HIGH' WHEN gap < 7 THEN 'MEDIUM' ELSE 'LOW' END AS level,
               COUNT(*) AS n FROM order_lines GROUP BY 2
        UNION ALL
        SELECT 'margin', CASE WHEN profit < -1000 THEN 'CRITICAL' WHEN profit < -500 THEN 'HIGH' WHEN profit < 0 THEN 'MEDIUM' ELSE 'LOW' END,
               COUNT(*) FROM order_lines GROUP BY 2""")
)
def rule_severity(spark: SparkSession, folder: str) -> DataFrame:
    return rules.severity_counts(_lines(spark, folder))


@REGISTRY.query(
    """
    SELECT event_id, CASE WHEN value < 15 THEN 'LOW' WHEN value < 30 THEN 'MEDIUM' WHEN value < 50 THEN 'HIGH' ELSE 'CRITICAL' END AS severity
    FROM events"""
)
def rule_frequency_bands(spark: SparkSession, folder: str) -> DataFrame:
    """Frequency bands over a spread-out value."""
    events = bindings.table(spark, folder, "events")
    return events.select("event_id", bands.severity(F.col("value"), bands.FREQUENCY_BANDS).alias("severity"))


@REGISTRY.query(
    """
    WITH counted AS (SELECT user_id % 10 AS customer, CAST(ts AS DATE) AS day, COUNT(DISTINCT event_id) AS orders FROM events GROUP BY ALL)
    SELECT customer, CAST(day AS VARCHAR) AS day, orders,
           CASE WHEN orders >= 50 THEN 'CRITICAL' WHEN orders >= 30 THEN 'HIGH' WHEN orders >= 15 THEN 'MEDIUM' ELSE 'LOW' END AS severity
    FROM counted WHERE orders > 5"""
)
def rule_group_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Orders a day of groups of customers, busy enough for the upper bands."""
    events = bindings.table(spark, folder, "events").withColumn("group", F.col("user_id") % 10)
    return rules.order_frequency(events, "group", F.to_date("ts"), "event_id", limit=5)


def _score_sql(rows: str) -> str:
    return f"""
        counts AS ({rows}),
        base AS (SELECT *, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS p, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS r FROM counts)
        SELECT rule_type, evaluation_period, tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
               round_even(p, 4) AS precision, round_even(r, 4) AS recall, round_even(COALESCE(2 * (p * r) / NULLIF(p + r, 0), 0), 4) AS f1_score,
               round_even(COALESCE(CAST(fp AS DOUBLE) / NULLIF(fp + tn, 0), 0), 4) AS false_positive_rate,
               round_even(COALESCE(CAST(fn AS DOUBLE) / NULLIF(fn + tp, 0), 0), 4) AS false_negative_rate,
               round_even(COALESCE(CAST(tp + tn AS DOUBLE) / NULLIF(tp + fp + tn + fn, 0), 0), 4) AS accuracy
        FROM base"""


def _counts_sql(rule: str, label: str, value: str, fraud: int, source: str, where: str) -> str:
    return f"""SELECT '{rule}' AS rule_type, '{label}' AS evaluation_period,
        COUNT(*) FILTER ({value} < 0 AND {value} < {fraud}) AS tp, COUNT(*) FILTER ({value} < 0 AND NOT {value} < {fraud}) AS fp,
        COUNT(*) FILTER (NOT {value} < 0 AND NOT {value} < {fraud}) AS tn, COUNT(*) FILTER (NOT {value} < 0 AND {value} < {fraud}) AS fn
        FROM {source} WHERE order_status NOT IN {STRICT}{where}"""


_RANGE = " AND order_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'"
_LABEL = "1997-01-01 to 1998-12-31"


def _metrics_sql(rows: str) -> str:
    return sql_with("order_lines", body="") + "," + _score_sql(rows)


_TIMING_ALL = _counts_sql("timing_fraud", "all", "gap", -7, "order_lines", "")
_MARGIN_ALL = _counts_sql("negative_margin", "all", "profit", -1000, "so", "")


@REGISTRY.query(_metrics_sql(_TIMING_ALL))
def metrics_timing(spark: SparkSession, folder: str) -> DataFrame:
    orders = bindings.sales_orders(spark, folder, customer=False, profit=False)
    return metrics.timing_rule(orders, bindings.shipping_logs(spark, folder))


@REGISTRY.query(_metrics_sql(_counts_sql("negative_margin", _LABEL, "profit", -1000, "so", _RANGE)))
def metrics_margin(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.margin_rule(_orders(spark, folder), "1997-01-01", "1998-12-31")


@REGISTRY.query(_metrics_sql(f"{_TIMING_ALL} UNION ALL {_MARGIN_ALL}"))
def metrics_all(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.evaluate_all(_orders(spark, folder), bindings.shipping_logs(spark, folder))


@REGISTRY.query(
    f"SELECT *, false_positive_rate > 0.05 AS too_many_false_alarms, recall < 0.8 AS misses_too_much FROM ({_metrics_sql(f'{_TIMING_ALL} UNION ALL {_MARGIN_ALL}')})"
)
def metrics_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.with_alerts(
        metrics.evaluate_all(_orders(spark, folder), bindings.shipping_logs(spark, folder))
    )


@REGISTRY.query(
    sql_with("order_lines", body="") + "," + _score_sql(
        f"""SELECT 'timing_fraud' AS rule_type, 'all' AS evaluation_period,
            COUNT(*) FILTER (gap < 0 AND fraud) AS tp, COUNT(*) FILTER (gap < 0 AND NOT fraud) AS fp,
            COUNT(*) FILTER (gap >= 0 AND NOT fraud) AS tn, COUNT(*) FILTER (gap >= 0 AND fraud) AS fn
            FROM (SELECT gap, order_status = 'COMPLETE' AS fraud FROM order_lines WHERE order_status NOT IN {STRICT})"""
    )
)
def metrics_labelled(spark: SparkSession, folder: str) -> DataFrame:
    """The timing rule against a label table instead of the built-in guess."""
    orders = bindings.sales_orders(spark, folder, customer=False, profit=False)
    labels = orders.select("order_id", (F.col("order_status") == "COMPLETE").alias("is_fraud"))
    return metrics.timing_rule(orders, bindings.shipping_logs(spark, folder), labels=labels)
