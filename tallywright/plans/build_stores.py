"""One raw extract to the tables of the three stores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallywright.operators import ingest
from tallywright.schemas import STORES
from tallywright.sources import catalog, quarantine, readers, sinks


@dataclass
class CanonicalTables:
    products: DataFrame
    sales_orders: DataFrame
    shipping_logs: DataFrame
    general_ledger: DataFrame
    accounts_receivable: DataFrame
    rejects: DataFrame
    counts: quarantine.Counts | None = None


def canonical_tables(
    raw: DataFrame, loaded_at: str | None = None, sum_lines: bool = False, reuse: bool = False
) -> CanonicalTables:
    """All tables of one extract as lazy frames.

    ``reuse`` writes the judged lines once to the shared folder (:mod:`quarantine`), so five writers do
    not parse the text five times, and checks that no line is lost on the way.
    """
    judge = quarantine.raw_lines()
    parted = quarantine.split(raw, judge) if reuse else None
    lines = parted.rows.drop(quarantine.OUTCOME) if parted else judge(raw)
    good = ingest.accepted_lines(lines)
    numbered = ingest.numbered_lines(good, keep={*ingest.SHIPPING_COLUMNS, *ingest.LEDGER_COLUMNS})
    return CanonicalTables(
        products=ingest.build_products(good, loaded_at=loaded_at),
        sales_orders=ingest.build_sales_orders(good, loaded_at=loaded_at, sum_lines=sum_lines),
        shipping_logs=ingest.build_shipping_logs(numbered, loaded_at=loaded_at),
        general_ledger=ingest.build_general_ledger(numbered, loaded_at=loaded_at),
        accounts_receivable=ingest.build_accounts_receivable(good, loaded_at=loaded_at),
        rejects=ingest.rejected_lines(lines),
        counts=parted.counts if parted else None,
    )


def build(spark: SparkSession, path: str, loaded_at: str, sum_lines: bool = False) -> DataFrame:
    """Read the extract, (re)write every table, return the row counts.

    Tables are replaced, so a second run leaves the same rows.  Orders are
    partitioned by year, see ``filters.date_range``.
    """
    catalog.create_stores(spark)
    tables = canonical_tables(readers.read_raw(spark, path), loaded_at, sum_lines, reuse=True)
    sinks.replace_table(tables.products, "operations.products")
    sinks.replace_table(tables.sales_orders, "operations.sales_orders", partition_by="order_year")
    sinks.replace_table(tables.shipping_logs, "operations.shipping_logs")
    sinks.replace_table(tables.general_ledger, "finance.general_ledger")
    sinks.replace_table(tables.accounts_receivable, "finance.accounts_receivable")
    sinks.replace_table(tables.rejects.drop("seq"), "operations.rejected_lines")
    create_audit_tables(spark)
    return catalog.table_counts(spark)


def create_audit_tables(spark: SparkSession) -> None:
    """Empty tables of the audit store where they do not exist yet."""
    catalog.create_stores(spark)
    for name, schema in STORES["audit"].items():
        if not spark.catalog.tableExists(f"audit.{name}"):
            spark.createDataFrame([], schema).write.format("parquet").saveAsTable(f"audit.{name}")
