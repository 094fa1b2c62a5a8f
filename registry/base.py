"""Registry of queries and the shared SQL building blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Plain result types: decimals as double, dates and timestamps as ISO text."""
    shown = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DecimalType):
            value = value.cast("double")
        elif isinstance(field.dataType, DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            value = value.cast("string")
        shown.append(value.alias(field.name))
    return df.select(*shown)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        """Register a function under its own name, with its SQL if there is one."""

        def add(fn: Query) -> Query:
            def run(spark: SparkSession, folder: str) -> DataFrame:
                return present(fn(spark, folder))

            self.queries[fn.__name__] = run
            if sql is not None:
                self.sql[fn.__name__] = sql.strip()
            return fn

        return add

    def merge(self, other: Registry) -> None:
        twice = self.queries.keys() & other.queries.keys()
        if twice:
            raise ValueError(f"registered twice: {sorted(twice)}")
        self.queries |= other.queries
        self.sql |= other.sql


STRICT = "('CANCELED', 'CANCELLED', 'SUSPECTED_FRAUD')"
BASIC = "('CANCELED', 'CANCELLED')"

_BLOCKS = {
    "earned": """
        SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2)))
               - CAST(l_quantity AS DECIMAL(7,2)) * CAST(p_retailprice AS DECIMAL(9,2))) AS profit
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey""",
    "so": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_mktsegment AS customer_segment,
               n_name AS customer_country, CAST(o_totalprice AS DECIMAL(18,2)) AS sales,
               CASE WHEN o_orderkey % 97 = 0 THEN 'SUSPECTED_FRAUD' WHEN o_orderstatus = 'P' THEN 'CANCELED'
                    WHEN o_orderstatus = 'F' THEN 'COMPLETE' ELSE 'PROCESSING' END AS order_status,
               o_orderpriority AS order_priority, CAST(COALESCE(profit, 0) AS DECIMAL(18,4)) AS profit
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
             LEFT JOIN earned ON l_orderkey = o_orderkey""",
    "sl": """
        SELECT sha256(concat_ws('|', 'SHIP', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS INTEGER),
                                strftime(l_shipdate, '%Y-%m-%d'))) AS log_id,
               CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_shipdate AS DATE) AS shipping_date
        FROM lineitem""",
    "ar0": """
        SELECT o_orderkey AS k, o_orderkey AS base, * FROM orders WHERE o_orderkey % 50 <> 0
        UNION ALL SELECT o_orderkey + 100000000, o_orderkey, * FROM orders WHERE o_orderkey % 101 = 0""",
    "ar": """
        SELECT sha256('AR|' || k) AS ar_id, CAST(k AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
               c_name AS customer_name,
               CAST(o_orderdate AS DATE) + CASE WHEN base % 29 = 0 THEN 3 WHEN base % 7 = 0 THEN 1 ELSE 0 END AS invoice_date,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) + CASE WHEN base % 37 = 0 THEN 5 ELSE 0 END AS DECIMAL(18,2)) AS invoice_amount,
               CASE WHEN base % 113 = 0 THEN 'Cancelled' WHEN o_orderstatus = 'F' THEN 'Paid' ELSE 'Outstanding' END AS payment_status
        FROM ar0 LEFT JOIN customer ON c_custkey = o_custkey""",
    "compared": f"""
        SELECT COALESCE(s.order_id, a.order_id) AS order_id, s.order_date, a.invoice_date, s.customer_name, s.sales, a.invoice_amount,
               s.order_id IS NOT NULL AS in_ops, a.order_id IS NOT NULL AS in_fin,
               COALESCE(s.order_status NOT IN {STRICT}, FALSE) AS active, COALESCE(a.payment_status <> 'Cancelled', FALSE) AS live,
               abs(s.sales - a.invoice_amount) AS amount_diff,
               CAST(date_diff('day', s.order_date, a.invoice_date) AS INTEGER) AS days_apart,
               CASE WHEN s.order_id IS NULL THEN 'FIN_ONLY'
                    WHEN s.order_status IN {STRICT} THEN 'EXCLUDED'
                    WHEN a.order_id IS NULL OR a.payment_status = 'Cancelled' THEN 'OPS_ONLY'
                    WHEN abs(s.sales - a.invoice_amount) > 0.01 THEN 'AMOUNT_MISMATCH'
                    WHEN abs(date_diff('day', s.order_date, a.invoice_date)) > 1 THEN 'DATE_MISMATCH'
                    ELSE 'OK' END AS status
        FROM so s FULL JOIN ar a ON s.order_id = a.order_id""",
    "order_lines": f"""
        SELECT so.order_id, sl.log_id, sl.shipping_date, so.order_date, so.profit, so.sales, so.order_status, so.customer_name,
               date_diff('day', so.order_date, sl.shipping_date) AS gap
        FROM so JOIN sl ON so.order_id = sl.order_id WHERE so.order_status NOT IN {BASIC}""",
    "raw": """
        SELECT CASE WHEN l_orderkey % 227 <> 0 THEN CAST(l_orderkey AS VARCHAR) END AS order_id,
               CASE WHEN l_orderkey % 223 <> 0 THEN CAST(o_orderdate AS DATE) END AS order_date,
               CAST(o_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, c_mktsegment AS customer_segment,
               CAST(l_partkey AS VARCHAR) AS product_id, p_name AS product_name, p_type AS category_name,
               CASE WHEN l_orderkey % 211 <> 0 THEN CAST(l_quantity AS INTEGER) END AS order_quantity,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS sales, CAST(l_discount AS DECIMAL(18,2)) AS discount,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2)))
                    - CAST(l_quantity AS DECIMAL(7,2)) * CAST(p_retailprice AS DECIMAL(9,2)) AS DECIMAL(18,2)) AS profit,
               CASE WHEN o_orderstatus = 'F' THEN 'Complete' WHEN o_orderstatus = 'P' THEN 'Cancelled' END AS order_status,
               o_orderpriority AS order_priority, CAST(l_shipdate AS DATE) AS shipping_date,
               CASE WHEN l_shipdate > o_orderdate THEN 1 ELSE 0 END AS late_delivery_risk, l_linestatus AS shipping_mode,
               l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
             LEFT JOIN customer ON c_custkey = o_custkey""",
    "good": "SELECT * FROM raw WHERE order_id IS NOT NULL AND order_quantity IS NOT NULL AND order_date IS NOT NULL",
    "last_line": """
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY l_linenumber DESC, l_shipdate DESC,
               l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM good) WHERE rn = 1""",
    # An unreadable order date does not cost an order its last line.
    "readable": "SELECT * FROM raw WHERE order_id IS NOT NULL AND order_quantity IS NOT NULL",
    "last_readable": """
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY l_linenumber DESC, l_shipdate DESC,
               l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn FROM readable) WHERE rn = 1""",
    "access": """
        SELECT CAST(event_id AS VARCHAR) AS log_id, event_id, ts AS audit_date, CAST(user_id AS VARCHAR) AS auditor_id,
               CASE event_type WHEN 'signup' THEN 'ROLE_GRANT' WHEN 'error' THEN 'PERMISSION_DENIED'
                               WHEN 'purchase' THEN 'EXPORT' ELSE 'READ' END AS action,
               event_type AS entity_type, json_extract_string(props, '$.k') AS entity_id, props AS notes
        FROM events""",
    "runs": """
        SELECT event_type AS system, CASE WHEN user_id % 2 = 0 THEN 'sales_orders' ELSE 'accounts_receivable' END AS table_name,
               date_trunc('day', ts) AS run_ts, COUNT(*) AS record_count, MAX(value) AS peak
        FROM events GROUP BY 1, 2, 3""",
}
_NEEDS = {
    "so": ("earned",),
    "ar": ("ar0",),
    "compared": ("so", "ar"),
    "order_lines": ("so", "sl"),
    "good": ("raw",),
    "last_line": ("good",),
    "readable": ("raw",),
    "last_readable": ("readable",),
}


def sql_with(*blocks: str, body: str) -> str:
    """``body`` behind the named blocks and whatever they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, ()):
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for block in blocks:
        visit(block)
    heads = ",\n".join(f"{name} AS ({_BLOCKS[name].strip()})" for name in ordered)
    return f"WITH {heads}\n{body.strip()}"
