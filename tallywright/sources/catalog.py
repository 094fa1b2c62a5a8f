"""The three stores as Spark databases."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tallywright.operators import quality
from tallywright.schemas import STORES


def create_stores(spark: SparkSession) -> None:
    for store in STORES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {store}")


def require_store(spark: SparkSession, store: str) -> str:
    if store not in STORES:
        raise ValueError(f"unknown store: {store}; known: {sorted(STORES)}")
    if not spark.catalog.databaseExists(store):
        raise ValueError(f"store does not exist yet: {store}; build the stores first")
    return store


def table(spark: SparkSession, store: str, name: str) -> DataFrame:
    require_store(spark, store)
    if not spark.catalog.tableExists(f"{store}.{name}"):
        raise ValueError(f"no table {name} in store {store}")
    return spark.table(f"{store}.{name}")


def query(spark: SparkSession, store: str, sql: str, args: dict[str, Any] | list | None = None) -> DataFrame:
    """SQL with bare table names resolved in one store; ``store.table`` reaches the others."""
    require_store(spark, store)
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(store)
    try:
        return spark.sql(sql, args=args) if args else spark.sql(sql)
    finally:
        spark.catalog.setCurrentDatabase(before)


def query_many(spark: SparkSession, queries: dict[str, str]) -> dict[str, DataFrame]:
    """One query per store."""
    return {store: query(spark, store, sql) for store, sql in queries.items() if sql}


def list_tables(spark: SparkSession, store: str) -> list[str]:
    require_store(spark, store)
    return sorted(t.name for t in spark.catalog.listTables(store) if not t.isTemporary)


def table_info(spark: SparkSession, store: str, name: str) -> DataFrame:
    require_store(spark, store)
    return spark.sql(f"DESCRIBE TABLE {store}.{name}")


def table_count(spark: SparkSession, store: str, name: str) -> DataFrame:
    return quality.table_counts({name: table(spark, store, name)})


def table_counts(spark: SparkSession) -> DataFrame:
    """Rows of every table in every store that exists."""
    found = {}
    for store in STORES:
        if spark.catalog.databaseExists(store):
            found |= {f"{store}.{t}": spark.table(f"{store}.{t}") for t in list_tables(spark, store)}
    if not found:
        raise ValueError("no store has been built yet")
    return quality.table_counts(found)
