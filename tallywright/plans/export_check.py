"""Check one transaction export and write its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallywright.operators import rules
from tallywright.sources import readers, sinks

REPORT_VERSION = "2.0.0"


def report(spark: SparkSession, path: str, run_id: str, timestamp: str) -> DataFrame:
    """Rows, anomalies and the first ten of them, one row."""
    export = readers.with_row_number(readers.read_export(spark, path))
    summary = rules.export_summary(export)
    return summary.select(
        F.lit(run_id).alias("run_id"),
        F.lit(REPORT_VERSION).alias("version"),
        F.lit(timestamp).alias("timestamp"),
        F.lit(path).alias("input_file"),
        "rows_processed",
        "anomalies_found",
        "anomaly_list",
    )


def run(spark: SparkSession, path: str, output: str, run_id: str, timestamp: str) -> str:
    """Validate, check and write; returns the report's path."""
    verdict = readers.validate_export(spark, path)
    if not verdict["valid"]:
        raise ValueError(verdict["error"])
    target = f"{output}/reconciliation_report_{run_id}"
    sinks.write_json_report(report(spark, path, run_id, timestamp), target)
    return target
