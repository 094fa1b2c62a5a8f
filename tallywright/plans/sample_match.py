"""Match the sample ledger to the sample orders and report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywright.operators import recon
from tallywright.schemas import FINANCE_SAMPLE, OPERATIONS_SAMPLE
from tallywright.sources import readers, sinks


def match(spark: SparkSession, orders_path: str, ledger_path: str) -> tuple[DataFrame, DataFrame]:
    """Ledger rows with their verdict, and the summary."""
    orders = readers.read_sample(spark, orders_path, OPERATIONS_SAMPLE)
    ledger = readers.read_sample(spark, ledger_path, FINANCE_SAMPLE)
    matches = recon.match_ledger(orders, ledger, order_seq="seq")
    return matches, recon.match_summary(orders, matches)


def run(spark: SparkSession, orders_path: str, ledger_path: str, output: str, timestamp: str) -> str:
    _, summary = match(spark, orders_path, ledger_path)
    fields = [c for c in summary.columns if c != "match_rate"]
    shown = F.format_string("%.1f%%", F.col("match_rate")).alias("match_rate")
    one = summary.select(
        F.lit("DEMO").alias("mode"), F.lit(timestamp).alias("timestamp"), F.struct(*fields, shown).alias("summary")
    )
    target = f"{output}/quickstart_report"
    sinks.write_json_report(one, target)
    return target
