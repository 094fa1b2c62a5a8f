"""Profile a raw extract, drop repeated rows, write CSV and Parquet."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallywright.operators import quality
from tallywright.sources import readers, sinks


@dataclass
class Profile:
    shape: DataFrame
    types: list[tuple[str, str]]
    missing: DataFrame
    repeated: DataFrame


def profile(raw: DataFrame) -> Profile:
    return Profile(
        quality.shape(raw), quality.column_types(raw), quality.null_profile(raw), quality.dedupe_summary(raw)
    )


def run(spark: SparkSession, path: str, folder: str, name: str) -> tuple[str, str]:
    raw = readers.read_raw(spark, path).drop("seq")
    return sinks.write_processed(quality.dedupe(raw), folder, name)
