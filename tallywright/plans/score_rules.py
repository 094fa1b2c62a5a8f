"""Score the rules over the last days and store the scores."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tallywright.operators import metrics
from tallywright.plans.build_stores import create_audit_tables
from tallywright.sources import catalog, sinks

LOOK_BACK_DAYS = 30


def run(spark: SparkSession, as_of: dt.date, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Scores with alerts for the look-back window; appended to the audit store once."""
    start = as_of - dt.timedelta(days=days)
    orders = catalog.table(spark, "operations", "sales_orders")
    shipments = catalog.table(spark, "operations", "shipping_logs")
    scores = metrics.evaluate_all(orders, shipments, start, as_of)
    create_audit_tables(spark)
    sinks.append_new(metrics.to_table(scores, as_of.isoformat()), "audit.fraud_rule_metrics", "metric_id")
    return metrics.with_alerts(scores)
