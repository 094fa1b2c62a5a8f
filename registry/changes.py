"""Changes applied to stored tables, and what does not convert."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import Registry, sql_with
from tallywright.operators import erp, ingest, windows
from tallywright.session import work_dir
from tallywright.sources import bindings, quarantine, readers, sinks

REGISTRY = Registry()

LIVE = """
    SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(sales + CASE WHEN k % 10 = 0 THEN 5 ELSE 0 END AS DOUBLE) AS sales,
           CASE WHEN k % 10 = 0 THEN 'CHANGED' ELSE order_status END AS order_status
    FROM (SELECT *, CAST(order_id AS BIGINT) AS k FROM so) WHERE k % 7 <> 0"""


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = bindings.sales_orders(spark, folder, customer=False, profit=False).select("order_id", "order_date", "sales", "order_status")
    return orders.withColumns({"k": F.col("order_id").cast("long"), "year": F.year("order_date")})


def order_changes(spark: SparkSession, folder: str) -> list[DataFrame]:
    """A first load; newer rows and, out of order, older ones; deletes followed by what came before them."""
    orders = _orders(spark, folder)
    newer = orders.where("k % 10 = 0").withColumns({"sales": (F.col("sales") + 5).cast("decimal(18,2)"), "order_status": F.lit("CHANGED")})
    older = orders.where("k % 3 = 0").withColumn("order_status", F.lit("STALE"))
    gone = orders.where("k % 7 = 0")
    shape = lambda df, seq, op: df.drop("k").withColumns({"seq": F.lit(seq), "op": F.lit(op)})
    return [shape(orders, 1, "I"), shape(newer, 3, "U"), shape(older, 0, "U"), shape(gone, 5, "D"), shape(gone, 4, "U")]


@REGISTRY.query(sql_with("so", body=LIVE))
def upsert_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders after updates, late older changes and deletes, in a table partitioned by year."""
    name = f"tw_orders_{uuid.uuid4().hex}"
    for change in order_changes(spark, folder):
        sinks.upsert(change, name, "order_id", "seq", "year", F.col("op") == "D")
    work_dir(spark)
    state = sinks.live(spark, name).drop("year", "op").checkpoint()
    spark.sql(f"DROP TABLE {name}")
    return state


@REGISTRY.query(
    sql_with("raw", body="""
        SELECT CAST(count(*) AS BIGINT) AS lines, CAST(count(order_id) AS BIGINT) AS with_key, CAST(count(DISTINCT order_id) AS BIGINT) AS orders
        FROM raw""")
)
def keep_last_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Keep-last where a third of the lines has no sequence: lines, lines with a key, keys kept."""
    raw = bindings.raw_extract(spark, folder, product=False, customer=False)
    lines = raw.select(F.col("Order ID").alias("order_id"), F.when(F.col("seq.l_linenumber") % 3 != 0, F.col("seq")).alias("seq"))
    kept = windows.keep_last(lines, "order_id", "seq").agg(F.count("order_id").alias("orders"))
    return lines.agg(F.count("*").alias("lines"), F.count("order_id").alias("with_key")).withColumn("orders", kept.scalar())


@REGISTRY.query(
    sql_with("raw", body="""
        SELECT order_id, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DOUBLE) AS l_quantity FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY l_linenumber DESC, l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
            FROM raw WHERE order_id IS NOT NULL AND l_linenumber % 3 <> 0)
        WHERE rn = 1
        UNION ALL SELECT order_id, NULL, NULL, NULL, NULL FROM raw WHERE order_id IS NOT NULL GROUP BY order_id HAVING COUNT(*) FILTER (l_linenumber % 3 <> 0) = 0""")
)
def keep_last_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows kept where a third of the lines has no sequence."""
    raw = bindings.raw_extract(spark, folder, product=False, customer=False)
    lines = raw.select(F.col("Order ID").alias("order_id"), F.when(F.col("seq.l_linenumber") % 3 != 0, F.col("seq")).alias("seq"))
    return windows.keep_last(lines, "order_id", "seq").select("order_id", *[f"seq.{c}" for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")])


def _export(spark: SparkSession, folder: str) -> DataFrame:
    """A transaction export with unreadable cells."""
    key = F.col("o_orderkey")
    return bindings.table(spark, folder, "orders").select(
        key.cast("string").alias("transaction_id"),
        F.when(key % 7 == 0, F.concat(F.lit("1,"), key.cast("string"))).otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("amount"),
        F.when(key % 11 == 0, "43131").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"),
        F.lit("4000").alias("account_code"),
    )


def _extract(spark: SparkSession, folder: str) -> DataFrame:
    """An ERP extract with unreadable cells."""
    key = F.col("VBELN").cast("long")
    return bindings.erp_orders(spark, folder, "sap").withColumns(
        {"AUDAT": F.when(key % 13 == 0, "2024-13-45").otherwise(F.col("AUDAT")), "NETWR": F.when(key % 5 == 0, "1,234.50").otherwise(F.col("NETWR"))}
    )


@REGISTRY.query(
    """
        SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_orderkey % 7 = 0 AS amount_unreadable, o_orderkey % 11 = 0 AS date_unreadable
        FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 11 = 0"""
)
def export_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Cells of a transaction export that do not read."""
    typed = readers.typed_export(_export(spark, folder)).where("amount_unreadable OR date_unreadable")
    return typed.select("transaction_id", "amount_unreadable", "date_unreadable")


@REGISTRY.query("""
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS order_id,
           CASE WHEN o_orderkey % 13 = 0 THEN '2024-13-45' ELSE strftime(o_orderdate, '%Y%m%d') END AS order_date,
           CASE WHEN o_orderkey % 5 = 0 THEN '1,234.50' ELSE CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS VARCHAR) END AS sales,
           concat_ws('; ', CASE WHEN o_orderkey % 13 = 0 THEN 'order_date unreadable' END, CASE WHEN o_orderkey % 5 = 0 THEN 'sales unreadable' END) AS reject_reason
    FROM orders WHERE o_orderkey % 13 = 0 OR o_orderkey % 5 = 0""")
def erp_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of an ERP extract that do not convert."""
    return erp.rejects(_extract(spark, folder), "sap", "sales_orders", amounts_in_cents=True).select("order_id", "order_date", "sales", "reject_reason")


_FIRST, _LAST = "1996-01-01", "1999-12-31"


def _split(spark: SparkSession, folder: str) -> dict[str, quarantine.Split]:
    raw = bindings.raw_extract(spark, folder, product=False, customer=False)
    return {
        "raw": quarantine.split(raw, quarantine.raw_lines()),
        "erp": quarantine.split(_extract(spark, folder), quarantine.erp_rows("sap", "sales_orders", _FIRST, _LAST, amounts_in_cents=True)),
        "export": quarantine.split(_export(spark, folder), quarantine.export_rows),
    }


_OUTCOMES = f"""
        outcomes AS (
            SELECT 'raw' AS path, CASE WHEN order_id IS NULL OR order_quantity IS NULL OR order_date IS NULL THEN 'rejected' ELSE 'accepted' END AS outcome,
                concat_ws('; ', CASE WHEN order_id IS NULL THEN 'order_id missing' END, CASE WHEN order_quantity IS NULL THEN 'order_quantity unreadable' END,
                    CASE WHEN order_date IS NULL THEN 'order_date unreadable' END) AS reason FROM raw
            UNION ALL
            SELECT 'erp', CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 5 = 0 THEN 'rejected'
                WHEN CAST(o_orderdate AS DATE) BETWEEN DATE '{_FIRST}' AND DATE '{_LAST}' THEN 'accepted' ELSE 'out_of_range' END,
                concat_ws('; ', CASE WHEN o_orderkey % 13 = 0 THEN 'order_date unreadable' END, CASE WHEN o_orderkey % 5 = 0 THEN 'sales unreadable' END) FROM orders
            UNION ALL
            SELECT 'export', CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'rejected' ELSE 'accepted' END,
                concat_ws('; ', CASE WHEN o_orderkey % 7 = 0 THEN 'amount unreadable' END, CASE WHEN o_orderkey % 11 = 0 THEN 'date unreadable' END) FROM orders)"""


def _outcomes(body: str) -> str:
    return sql_with("raw", body="").rstrip() + "," + _OUTCOMES + body


@REGISTRY.query(
    _outcomes("""
        SELECT path, count(*) AS rows_in, count(*) FILTER (outcome = 'accepted') AS accepted, count(*) FILTER (outcome = 'rejected') AS rejected,
            count(*) FILTER (outcome = 'out_of_range') AS out_of_range
        FROM outcomes GROUP BY path""")
)
def quarantine_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What became of the rows of a raw, an ERP and an export source, as counted while writing."""
    told = [(path, p.counts.rows_in, p.counts.accepted, p.counts.rejected, p.counts.out_of_range) for path, p in _split(spark, folder).items()]
    return spark.createDataFrame(told, "path string, rows_in long, accepted long, rejected long, out_of_range long")


@REGISTRY.query(_outcomes("""
        SELECT path, reason AS reject_reason, count(*) AS n_rows FROM outcomes WHERE outcome = 'rejected' GROUP BY ALL"""))
def quarantine_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Stored rejects of the three paths by reason."""
    parts = [quarantine.reasons(p).withColumn("path", F.lit(path)) for path, p in _split(spark, folder).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@REGISTRY.query(
    """
    WITH priced AS (
        SELECT CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS price, (l_partkey + l_linenumber) % 9 = 0 AS missing, l_orderkey % 227 = 0 OR l_orderkey % 223 = 0 OR l_orderkey % 211 = 0 OR (l_partkey + l_linenumber) % 10 = 0 AND NOT (l_partkey + l_linenumber) % 9 = 0 AS bad
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT product_id, CAST(((2 * CAST(SUM(price) FILTER (NOT missing) * 100 AS HUGEINT) * 10000 + COUNT(*) FILTER (NOT missing)) // (2 * COUNT(*) FILTER (NOT missing)) + 5000) // 10000 AS DOUBLE) / 100 AS product_price
    FROM priced WHERE NOT bad GROUP BY product_id"""
)
def product_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Mean prices of a source with a price column of its own, some cells of which are empty or no number."""
    raw = bindings.raw_extract(spark, folder, product=False, customer=False)
    at = F.col("seq.l_partkey") + F.col("seq.l_linenumber")
    cell = F.when(at % 9 == 0, "").when(at % 10 == 0, "on request").otherwise(F.col("Sales"))
    lines = ingest.judged_lines(ingest.harmonise(raw.withColumn("Product Price", cell).drop("Sales")))
    return ingest.build_products(ingest.accepted_lines(lines)).select("product_id", "product_price")
