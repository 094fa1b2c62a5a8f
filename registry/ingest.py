"""Raw lines and ERP extracts to canonical tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import Registry, sql_with
from tallywright.functions import money
from tallywright.operators import erp, ingest
from tallywright.sources import bindings, readers

REGISTRY = Registry()


def _good(spark: SparkSession, folder: str, lenient: tuple[str, ...] = (), **parts: bool) -> DataFrame:
    return ingest.accepted_lines(ingest.judged_lines(ingest.harmonise(bindings.raw_extract(spark, folder, **parts)), lenient))


_TEXT = """order_id, CASE WHEN order_date IS NULL THEN '99/99/9999' ELSE strftime(order_date, '%-m/%-d/%Y') || ' 0:00' END AS order_date,
    customer_id, customer_id AS customer_key, customer_name, customer_segment, CAST(NULL AS VARCHAR) AS customer_country,
    product_id, CASE WHEN order_quantity IS NULL THEN 'abc' ELSE CAST(l_quantity AS VARCHAR) END AS order_quantity,
    CAST(sales AS VARCHAR) AS sales, order_status, CAST(late_delivery_risk AS VARCHAR) AS late_delivery_risk, shipping_mode"""


@REGISTRY.query(sql_with("raw", body=f"SELECT {_TEXT} FROM raw"))
def harmonise(spark: SparkSession, folder: str) -> DataFrame:
    lines = ingest.harmonise(bindings.raw_extract(spark, folder, product=False))
    return lines.select(
        "order_id", "order_date", "customer_id", "customer_key", "customer_name", "customer_segment", "customer_country",
        "product_id", "order_quantity", "sales", "order_status", "late_delivery_risk", "shipping_mode",
    )


_REASONS = """concat_ws('; ', CASE WHEN order_id IS NULL THEN 'order_id missing' END, CASE WHEN order_quantity IS NULL THEN 'order_quantity unreadable' END,
                   CASE WHEN order_date IS NULL THEN 'order_date unreadable' END)"""


@REGISTRY.query(
    sql_with("raw", body=f"""
        SELECT order_id, product_id, CAST(sales AS VARCHAR) AS sales, CASE WHEN order_quantity IS NULL THEN 'abc' ELSE CAST(l_quantity AS VARCHAR) END AS order_quantity,
               {_REASONS} AS reject_reason
        FROM raw WHERE order_id IS NULL OR order_quantity IS NULL OR order_date IS NULL""")
)
def ingest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    _, rejects = ingest.split_rejects(ingest.harmonise(bindings.raw_extract(spark, folder, False, False)))
    return rejects.select("order_id", "product_id", "sales", "order_quantity", "reject_reason")


_ORDER_HEAD = """order_id, CAST(order_date AS VARCHAR) AS order_date, customer_id, customer_name, customer_segment, product_id, product_name, category_name"""
_ORDER_TAIL = """order_status, order_priority, CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
    CAST(day(order_date) AS INTEGER) AS order_day, late_delivery_risk"""
_ORDER_COLUMNS = (
    "order_id", "order_date", "customer_id", "customer_name", "customer_segment", "product_id", "product_name", "category_name",
    "order_quantity", "sales", "discount", "profit", "order_status", "order_priority", "order_year", "order_month", "order_day",
    "late_delivery_risk",
)


@REGISTRY.query(
    sql_with("last_readable", body=f"""
        SELECT {_ORDER_HEAD}, order_quantity, CAST(sales AS DOUBLE) AS sales, CAST(discount AS DOUBLE) AS discount,
               CAST(profit AS DOUBLE) AS profit, {_ORDER_TAIL} FROM last_readable""")
)
def ingest_orders_keep_last(spark: SparkSession, folder: str) -> DataFrame:
    """The last line of every order; one whose date does not read is kept without it."""
    return ingest.build_sales_orders(_good(spark, folder, lenient=("order_date",))).select(*_ORDER_COLUMNS)


@REGISTRY.query(
    sql_with("last_line", body="""
        SELECT order_id, product_id, order_status, CAST(q AS INTEGER) AS order_quantity, CAST(s AS DOUBLE) AS sales, CAST(p AS DOUBLE) AS profit
        FROM last_line JOIN (SELECT order_id, SUM(order_quantity) AS q, SUM(sales) AS s, SUM(profit) AS p FROM good GROUP BY 1) USING (order_id)""")
)
def ingest_orders_sum_lines(spark: SparkSession, folder: str) -> DataFrame:
    orders = ingest.build_sales_orders(_good(spark, folder, customer=False), sum_lines=True)
    return orders.select("order_id", "product_id", "order_status", "order_quantity", "sales", "profit")


@REGISTRY.query(
    sql_with("good", body="""
        SELECT product_id, any_value(product_name) AS product_name, any_value(category_name) AS product_category,
               CAST(((2 * CAST(SUM(sales) * 100 AS HUGEINT) * 10000 + COUNT(*)) // (2 * COUNT(*)) + 5000) // 10000 AS DOUBLE) / 100 AS product_price
        FROM good GROUP BY product_id""")
)
def ingest_products(spark: SparkSession, folder: str) -> DataFrame:
    products = ingest.build_products(_good(spark, folder, customer=False))
    return products.select("product_id", "product_name", "product_category", "product_price")


def _numbered(product: bool) -> str:
    """The good lines with their stored ids: the SHA-256 of the digest of all columns by name and of
    the number among identical lines."""
    own = {"product_name", "category_name"} if product else set()
    lacking = {"category_name", "customer_city", "customer_country", "customer_name", "customer_segment", "days_for_shipment_real",
               "days_for_shipment_scheduled", "delivery_status", "market", "product_name", "region"} - own
    columns = sorted([*ingest.ALIASES, "customer_key"])
    sources = {c: "''" for c in lacking} | {"customer_key": "customer_id", "product_price": "sales"} | ({} if product else {"profit": "'0.00'"})
    told = ", ".join(f"coalesce(CAST({sources.get(c, c)} AS VARCHAR), '')" for c in columns)
    content = f"concat_ws('|', {told})"
    return f"""SELECT *, sha256(sha256({content}) || '|' || row_number() OVER (PARTITION BY {content})) AS line_id FROM good"""


@REGISTRY.query(
    sql_with("good", body=f"""
        SELECT sha256('SHIP|' || order_id || '|' || line_id) AS log_id, order_id, shipping_mode, CAST(shipping_date AS VARCHAR) AS shipping_date, late_delivery_risk,
               CAST(NULL AS INTEGER) AS days_for_shipment_real, CAST(NULL AS VARCHAR) AS market
        FROM ({_numbered(False)})""")
)
def ingest_shipping(spark: SparkSession, folder: str) -> DataFrame:
    logs = ingest.build_shipping_logs(ingest.numbered_lines(_good(spark, folder, product=False, customer=False), keep=ingest.SHIPPING_COLUMNS))
    return logs.select("log_id", "order_id", "shipping_mode", "shipping_date", "late_delivery_risk", "days_for_shipment_real", "market")


@REGISTRY.query(
    sql_with("last_line", body="""
        SELECT sha256('AR|' || order_id) AS ar_id, order_id, customer_id, customer_name, CAST(order_date AS VARCHAR) AS invoice_date,
               CAST(order_date + 30 AS VARCHAR) AS due_date, CAST(sales AS DOUBLE) AS invoice_amount,
               CASE WHEN order_status = 'Complete' THEN CAST(sales AS DOUBLE) ELSE 0 END AS paid_amount,
               CASE WHEN order_status IS NULL THEN CAST(sales AS DOUBLE) ELSE 0 END AS outstanding_amount,
               CASE order_status WHEN 'Complete' THEN 'Paid' WHEN 'Cancelled' THEN 'Cancelled' ELSE 'Outstanding' END AS payment_status,
               0 AS days_past_due
        FROM last_line""")
)
def ingest_ar(spark: SparkSession, folder: str) -> DataFrame:
    invoices = ingest.build_accounts_receivable(_good(spark, folder, product=False))
    return invoices.drop("created_at", "updated_at")


@REGISTRY.query(
    sql_with("good", body=f"""
        SELECT sha256(concat_ws('|', 'GL', order_id, line_id, '4000')) AS entry_id, order_id, CAST(order_date AS VARCHAR) AS transaction_date, '4000' AS account_code, 'Sales Revenue' AS account_name,
               CAST(0 AS DOUBLE) AS debit_amount, CAST(sales AS DOUBLE) AS credit_amount, 'Sales for Order ' || order_id AS description,
               order_id AS reference_number FROM ({_numbered(True)})
        UNION ALL
        SELECT sha256(concat_ws('|', 'GL', order_id, line_id, '5000')), order_id, CAST(order_date AS VARCHAR), '5000', 'Cost of Goods Sold', CAST(sales - profit AS DOUBLE), CAST(0 AS DOUBLE),
               'COGS for Order ' || order_id, order_id FROM ({_numbered(True)}) WHERE sales - profit > 0""")
)
def ingest_ledger(spark: SparkSession, folder: str) -> DataFrame:
    ledger = ingest.build_general_ledger(ingest.numbered_lines(_good(spark, folder, customer=False), keep=ingest.LEDGER_COLUMNS))
    return ledger.drop("created_at")


_ERP = """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
           CAST(o_custkey AS VARCHAR) AS customer_id, o_totalprice AS sales, 'USD' AS currency,
           CASE WHEN o_orderkey % 17 = 0 THEN '{unknown}' WHEN o_orderstatus = 'P' THEN 'CANCELED' WHEN o_orderstatus = 'F' THEN 'COMPLETE'
                WHEN o_orderkey % 3 = 0 THEN 'NEW' ELSE 'PROCESSING' END AS order_status,
           o_orderkey % 17 = 0 AS status_unmapped{more}
    FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'"""


@REGISTRY.query(_ERP.format(unknown="X", more=", lower(o_orderpriority) AS priority"))
def erp_sap(spark: SparkSession, folder: str) -> DataFrame:
    extract = bindings.erp_orders(spark, folder, "sap")
    extra = {"PRIO": ("priority", F.lower)}
    return readers.read_erp_extract(
        extract, "sap", "sales_orders", "1996-01-01", "1999-12-31", extra, amounts_in_cents=True
    )


@REGISTRY.query(_ERP.format(unknown="ON_HOLD", more=""))
def erp_oracle(spark: SparkSession, folder: str) -> DataFrame:
    extract = bindings.erp_orders(spark, folder, "oracle")
    return readers.read_erp_extract(extract, "oracle", "sales_orders", "1996-01-01", "1999-12-31")


@REGISTRY.query(
    """
    SELECT 'D' || o_orderkey AS document_id, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS invoice_date, o_totalprice AS invoice_amount,
           CASE WHEN o_orderstatus = 'F' THEN CAST(CAST(o_orderdate AS DATE) + 40 AS VARCHAR) END AS clearing_date
    FROM orders
    WHERE CAST(o_orderdate AS DATE) <= DATE '1999-12-31'
      AND (o_orderstatus <> 'F' OR CAST(o_orderdate AS DATE) + 40 > DATE '1999-12-31')"""
)
def erp_sap_open_items(spark: SparkSession, folder: str) -> DataFrame:
    """Receivables still open at the key date."""
    orders = bindings.table(spark, folder, "orders")
    key = F.col("o_orderkey").cast("string")
    extract = orders.select(
        F.concat(F.lit("D"), key).alias("BELNR"),
        F.lpad(key, 10, "0").alias("VBELN"),
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("KUNNR"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("BLDAT"),
        money.to_money(F.col("o_totalprice")).cast("string").alias("DMBTR"),
        F.when(
            F.col("o_orderstatus") == "F", F.date_format(F.date_add(F.to_date("o_orderdate"), 40), "yyyyMMdd")
        ).alias("AUGDT"),
    )
    return readers.read_erp_extract(extract, "sap", "accounts_receivable", "1999-01-01", "1999-12-31")


def _both_systems(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Orders that two systems know in part, with the day of their last change; Oracle lacks some currencies."""
    sap, oracle = bindings.erp_orders(spark, folder, "sap"), bindings.erp_orders(spark, folder, "oracle")
    key = F.col("VBELN").cast("long")
    sap = sap.where(key % 4 != 0).withColumn("AEDAT", F.date_format(F.date_add(F.to_date("AUDAT", "yyyyMMdd"), (key % 5).cast("int")), "yyyyMMdd"))
    key = F.col("OrderNumber").cast("long")
    oracle = oracle.where(key % 3 != 0).withColumns(
        {
            "LastUpdateDate": F.date_add(F.to_date(F.left("OrderedDate", F.lit(10))), (key % 4).cast("int")).cast("string"),
            "CurrencyCode": F.when(key % 5 != 0, "EUR"),
            "LineTotal": (money.to_money(F.col("LineTotal")) + F.when(key % 11 == 0, 1).otherwise(0)).cast("string"),
        }
    )
    extra = {"AEDAT": "changed_date", "PRIO": "priority", "LAST_UPDATE_DATE": "changed_date"}
    return {
        "sap": erp.from_erp(sap, "sap", "sales_orders", extra, amounts_in_cents=True).drop("status_unmapped"),
        "oracle": erp.from_erp(oracle, "oracle", "sales_orders", extra).drop("status_unmapped"),
    }


_SYSTEMS = """
    , both_ AS (SELECT o_orderkey AS k, o_orderkey % 4 <> 0 AS s, o_orderkey % 3 <> 0 AS o, *, s AND (NOT o OR k % 5 >= k % 4) AS s_new,
                       concat_ws(',', CASE WHEN o THEN 'oracle' END, CASE WHEN s THEN 'sap' END) AS systems,
                       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderkey % 12 <> 0)"""


@REGISTRY.query(
    f"""WITH none_ AS (SELECT 1) {_SYSTEMS}
    SELECT CAST(k AS VARCHAR) AS order_id, day AS order_date, CAST(o_custkey AS VARCHAR) AS customer_id,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN o AND k % 11 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS sales,
           CASE WHEN o THEN 'oracle' ELSE 'sap' END AS sales_from,
           CASE WHEN s AND (s_new OR k % 5 = 0) THEN 'USD' WHEN k % 5 <> 0 THEN 'EUR' END AS currency,
           CASE WHEN s AND (s_new OR k % 5 = 0) THEN 'sap' WHEN k % 5 <> 0 THEN 'oracle' END AS currency_from,
           CASE WHEN k % 17 = 0 THEN CASE WHEN s_new THEN 'X' ELSE 'ON_HOLD' END WHEN o_orderstatus = 'P' THEN 'CANCELED' WHEN o_orderstatus = 'F' THEN 'COMPLETE'
                WHEN k % 3 = 0 THEN 'NEW' ELSE 'PROCESSING' END AS order_status,
           CASE WHEN s_new THEN 'sap' ELSE 'oracle' END AS order_status_from, CASE WHEN s THEN o_orderpriority END AS priority, systems
    FROM both_"""
)
def erp_combined(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of two systems in one frame: sales as Oracle has them, all else as last changed."""
    rows = erp.combine(_both_systems(spark, folder), "order_id", "changed_date", {"sales": ["oracle", "sap"]})
    return rows.select("order_id", "order_date", "customer_id", "sales", "sales_from", "currency", "currency_from", "order_status", "order_status_from", "priority", "systems")


@REGISTRY.query(
    f"""WITH none_ AS (SELECT 1) {_SYSTEMS}
    SELECT 'D' || k AS document_id, CASE WHEN s THEN CAST(k AS VARCHAR) END AS order_id, CASE WHEN o THEN CAST(k AS VARCHAR) END AS invoice_id, day AS invoice_date,
           CAST(o_custkey AS VARCHAR) AS customer_id, CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN NOT s_new AND k % 13 = 0 THEN 2 ELSE 0 END AS DOUBLE) AS invoice_amount,
           CASE WHEN s_new THEN 'sap' ELSE 'oracle' END AS invoice_amount_from, CASE WHEN o THEN CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_totalprice END END AS outstanding_amount,
           CASE WHEN o THEN 'EUR' END AS currency, systems
    FROM both_"""
)
def erp_combined_ar(spark: SparkSession, folder: str) -> DataFrame:
    """Receivables of two systems in one frame, by document number."""
    orders = bindings.table(spark, folder, "orders")
    key, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    amount, text = money.to_money(F.col("o_totalprice")), key.cast("string")
    sap = orders.where(key % 4 != 0).select(
        F.concat(F.lit("D"), text).alias("BELNR"),
        F.lpad(text, 10, "0").alias("VBELN"),
        F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("KUNNR"),
        F.date_format(day, "yyyyMMdd").alias("BLDAT"),
        amount.cast("string").alias("DMBTR"),
        F.date_format(F.date_add(day, (key % 5).cast("int")), "yyyyMMdd").alias("AEDAT"),
    )
    oracle = orders.where(key % 3 != 0).select(
        text.alias("CUSTOMER_TRX_ID"),
        F.concat(F.lit("D"), text).alias("TRX_NUMBER"),
        day.cast("string").alias("TRX_DATE"),
        F.col("o_custkey").cast("string").alias("BILL_TO_CUSTOMER_ID"),
        F.lit("EUR").alias("INVOICE_CURRENCY_CODE"),
        (amount + F.when(key % 13 == 0, 2).otherwise(0)).cast("string").alias("TOTAL_LINE_AMOUNT"),
        F.when(F.col("o_orderstatus") == "F", "0").otherwise(amount.cast("string")).alias("AMOUNT_DUE_REMAINING"),
        F.date_add(day, (key % 4).cast("int")).cast("string").alias("LAST_UPDATE_DATE"),
    )
    both = {
        "sap": erp.from_erp(sap, "sap", "accounts_receivable", {"AEDAT": "changed_date"}),
        "oracle": erp.from_erp(oracle, "oracle", "accounts_receivable", {"TRX_NUMBER": "document_id", "LAST_UPDATE_DATE": "changed_date"}),
    }
    rows = erp.combine(both, "document_id", "changed_date")
    return rows.select("document_id", "order_id", "invoice_id", "invoice_date", "customer_id", "invoice_amount", "invoice_amount_from", "outstanding_amount", "currency", "systems")
