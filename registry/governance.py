"""Findings, the audit log, masked views, integrity and retention."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry.base import STRICT, Registry, sql_with
from tallywright.operators import audit_log, governance, ingest
from tallywright.session import work_dir
from tallywright.sources import bindings, sealed_log
from tallywright.sources.append_log import AppendLog

REGISTRY = Registry()
AS_OF = "2001-08-01 00:00:00"
ACCESS_AS_OF = "2024-01-30 12:00:00"


def _findings(spark: SparkSession, folder: str) -> DataFrame:
    return audit_log.all_findings(
        bindings.sales_orders(spark, folder, customer=False),
        bindings.accounts_receivable(spark, folder),
        bindings.shipping_lines(spark, folder),
        AS_OF,
        bindings.SHIPMENT,
        bindings.shipment_id(),
    )


_FOUND = f"""
    , found AS (
        SELECT 'RECON_MISSING_AR' AS rule, 'HIGH' AS level, 'Order shipped but not booked in AR' AS text, order_id, '' AS line FROM so
        WHERE order_status NOT IN {STRICT} AND order_id NOT IN (SELECT order_id FROM ar WHERE payment_status <> 'Cancelled')
        UNION ALL
        SELECT 'RECON_AMOUNT_MISMATCH', 'MEDIUM', 'Sales amount differs from AR amount', so.order_id, '' FROM so JOIN ar ON so.order_id = ar.order_id
        WHERE order_status NOT IN {STRICT} AND payment_status <> 'Cancelled' AND abs(sales - invoice_amount) > 0.01
        UNION ALL
        SELECT 'SC_TIMING_FRAUD', 'CRITICAL', 'Shipping Date < Order Date', order_id, log_id FROM order_lines WHERE shipping_date < order_date
        UNION ALL
        SELECT 'SC_NEGATIVE_MARGIN', 'MEDIUM', 'Profit < 0 on active order', order_id, log_id FROM order_lines WHERE profit < 0)"""


def _found_sql(body: str) -> str:
    return sql_with("order_lines", "ar", body=_FOUND + body)


_SHOWN = ("log_id", "audit_date", "audit_type", "entity_type", "entity_id", "action", "notes", "risk_level", "status")


@REGISTRY.query(
    _found_sql(f"""
    SELECT sha256(rule || '|' || order_id || '|' || line) AS log_id, '{AS_OF}' AS audit_date, 'Automated' AS audit_type, 'Order' AS entity_type,
           order_id AS entity_id, rule AS action, text AS notes, level AS risk_level, 'Pending' AS status FROM found""")
)
def findings(spark: SparkSession, folder: str) -> DataFrame:
    return _findings(spark, folder).select(*_SHOWN)


@REGISTRY.query(_found_sql("SELECT level AS risk_level, COUNT(*) AS n FROM found GROUP BY level"))
def findings_by_level(spark: SparkSession, folder: str) -> DataFrame:
    return audit_log.by_level(_findings(spark, folder))


@REGISTRY.query(
    _found_sql(f"""
    SELECT sha256(rule || '|' || order_id || '|' || line) AS log_id, '{AS_OF}' AS audit_date, order_id, rule AS risk_type, level AS risk_level, text AS notes
    FROM found ORDER BY log_id LIMIT 20""")
)
def findings_latest(spark: SparkSession, folder: str) -> DataFrame:
    return audit_log.latest(_findings(spark, folder), 20)


@REGISTRY.query(
    _found_sql("""
    SELECT sha256(rule || '|' || order_id || '|' || line) AS log_id, rule AS action FROM found WHERE rule <> 'SC_NEGATIVE_MARGIN'""")
)
def findings_not_logged(spark: SparkSession, folder: str) -> DataFrame:
    """What a second run would add to a log that holds one rule's findings only."""
    found = _findings(spark, folder)
    log = found.where(F.col("action") == "SC_NEGATIVE_MARGIN")
    return audit_log.not_yet_logged(found, log).select("log_id", "action")


@REGISTRY.query(
    _found_sql("""
        SELECT sha256(rule || '|' || order_id || '|' || line) AS log_id, '2002-01-0' || (CAST(order_id AS BIGINT) % 3 + 1) AS day, rule AS action FROM found""")
)
def append_log(spark: SparkSession, folder: str) -> DataFrame:
    """Findings logged on three days, each day repeating all that was found before: a line keeps the day on
    which it came first."""
    found = _findings(spark, folder).select("log_id", "action", "entity_id").persist()  # found once, logged thrice
    log = AppendLog(spark, f"{work_dir(spark)}/log-{uuid.uuid4().hex}", "log_id", F.col("day"), prefixes=16)
    try:
        for k in range(3):
            log.append(found.where(F.col("entity_id").cast("long") % 3 <= k).withColumn("day", F.lit(f"2002-01-0{k + 1}")))
    finally:
        found.unpersist()
    return log.read().select("log_id", "day", "action")


@REGISTRY.query(
    _found_sql(f"""
    SELECT DISTINCT sha256('FLAG|' || rule || '|' || order_id) AS flag_id, '{AS_OF}' AS flag_date, rule AS risk_type, level AS severity,
           'Order' AS entity_type, order_id AS entity_id, text AS description, 'Open' AS status FROM found""")
)
def risk_flags(spark: SparkSession, folder: str) -> DataFrame:
    flags = audit_log.to_risk_flags(_findings(spark, folder))
    return flags.select(
        "flag_id", "flag_date", "risk_type", "severity", "entity_type", "entity_id", "description", "status"
    )


@REGISTRY.query(
    sql_with("so", body="""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, customer_id, left(customer_name, 1) || '***' AS customer_name_masked,
               customer_segment, customer_country, CAST(sales AS DOUBLE) AS sales, CAST(profit AS DOUBLE) AS profit, order_status, order_priority
        FROM so""")
)
def masked_orders(spark: SparkSession, folder: str) -> DataFrame:
    return governance.masked_orders(bindings.sales_orders(spark, folder))


@REGISTRY.query(
    sql_with("ar", body="""
        SELECT ar_id, order_id, customer_id, left(customer_name, 1) || '***' AS customer_name_masked, CAST(invoice_date AS VARCHAR) AS invoice_date,
               CAST(invoice_date + 30 AS VARCHAR) AS due_date, CAST(invoice_amount AS DOUBLE) AS invoice_amount,
               CASE WHEN payment_status = 'Paid' THEN CAST(invoice_amount AS DOUBLE) ELSE 0 END AS paid_amount,
               CASE WHEN payment_status = 'Outstanding' THEN CAST(invoice_amount AS DOUBLE) ELSE 0 END AS outstanding_amount,
               payment_status, 0 AS days_past_due
        FROM ar""")
)
def masked_ar(spark: SparkSession, folder: str) -> DataFrame:
    return governance.masked_receivables(bindings.accounts_receivable(spark, folder, customer=True))


@REGISTRY.query(
    sql_with("access", body="""
        SELECT log_id, CAST(audit_date AS VARCHAR) AS audit_date, auditor_id, action, entity_type, entity_id, notes
        FROM access WHERE action LIKE '%PERMISSION%' OR action LIKE '%ROLE%' ORDER BY access.audit_date DESC, log_id""")
)
def permission_changes(spark: SparkSession, folder: str) -> DataFrame:
    return governance.permission_changes(bindings.access_log(spark, folder))


@REGISTRY.query(
    sql_with("access", body=f"""
        SELECT auditor_id, COUNT(*) AS access_count, COUNT(DISTINCT entity_type) AS entity_types
        FROM access WHERE audit_date >= TIMESTAMP '{ACCESS_AS_OF}' - INTERVAL 1 DAY GROUP BY auditor_id HAVING COUNT(*) > 3""")
)
def access_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    return governance.access_anomaly(bindings.access_log(spark, folder), ACCESS_AS_OF, limit=3)


_NOTES = """coalesce('"' || replace(replace(notes, '\\', '\\\\'), '"', '\\"') || '"', 'null')"""


def _json_sql(action: str) -> str:
    return (
        f"""'{{"action":"' || {action} || '","audit_date":"' || CAST(audit_date AS VARCHAR) || '","auditor_id":"' || auditor_id || '","entity_id":' """
        """|| coalesce('"' || entity_id || '"', 'null') || ',"entity_type":"' || entity_type || '","log_id":"' || log_id || '","notes":' || """
        f"""{_NOTES} || '}}'"""
    )


_ORIGINAL = f"sha256({_json_sql('action')})"
_CHANGED_ACTION = "CASE WHEN event_id % 101 = 0 THEN 'TAMPERED' ELSE action END"
_CHANGED = f"sha256({_json_sql(_CHANGED_ACTION)})"


def _tampered(log: DataFrame) -> DataFrame:
    changed = F.when(F.col("log_id").cast("bigint") % 101 == 0, F.lit("TAMPERED")).otherwise(F.col("action"))
    return log.withColumn("action", changed)


@REGISTRY.query(
    sql_with("access", body=f"SELECT log_id, CAST(audit_date AS VARCHAR) AS audit_date, auditor_id, action, entity_type, entity_id, notes, {_ORIGINAL} AS row_hash FROM access")
)
def row_hash(spark: SparkSession, folder: str) -> DataFrame:
    return governance.with_row_hash(_whole_log(spark, folder))


@REGISTRY.query(
    sql_with("access", body=f"""
        SELECT log_id, {_CHANGED} AS found_hash, {_ORIGINAL} AS stored_hash FROM access WHERE event_id % 101 = 0""")
)
def verify_hashes(spark: SparkSession, folder: str) -> DataFrame:
    log = _whole_log(spark, folder)
    return governance.verify_hashes(_tampered(log), governance.with_row_hash(log))


@REGISTRY.query(
    sql_with("access", body="""
        SELECT log_id, CASE WHEN event_id % 503 = 0 THEN 'DELETED' ELSE 'CHANGED' END AS violation
        FROM access WHERE event_id % 503 = 0 OR event_id % 101 = 0""")
)
def append_only_check(spark: SparkSession, folder: str) -> DataFrame:
    log = _whole_log(spark, folder)
    later = _tampered(log).where(F.col("log_id").cast("bigint") % 503 != 0)
    return governance.append_only_check(governance.with_row_hash(log), governance.with_row_hash(later))


@REGISTRY.query(
    sql_with("so", "ar", body="""
        , gl AS (SELECT order_date AS d FROM so UNION ALL SELECT order_date FROM so WHERE sales - CAST(profit AS DECIMAL(18,2)) > 0)
        SELECT 'sales_orders' AS table_name, COUNT(*) FILTER (order_date >= DATE '2001-01-01') AS kept, COUNT(*) FILTER (order_date < DATE '2001-01-01') AS expired FROM so
        UNION ALL SELECT 'accounts_receivable', COUNT(*) FILTER (invoice_date >= DATE '1996-01-01'), COUNT(*) FILTER (invoice_date < DATE '1996-01-01') FROM ar
        UNION ALL SELECT 'general_ledger', COUNT(*) FILTER (d >= DATE '1993-01-01'), COUNT(*) FILTER (d < DATE '1993-01-01') FROM gl""")
)
def retention(spark: SparkSession, folder: str) -> DataFrame:
    as_of = "2003-01-01"
    orders = bindings.sales_orders(spark, folder, customer=False, profit=False)
    earning = bindings.sales_orders(spark, folder, customer=False)
    ledger = ingest.build_general_ledger(
        earning.withColumn("profit", F.col("profit").cast("decimal(18,2)")), seq="order_status"
    )
    parts = [
        governance.retention_summary(orders, "sales_orders", "order_date", as_of),
        governance.retention_summary(
            bindings.accounts_receivable(spark, folder), "accounts_receivable", "invoice_date", as_of
        ),
        governance.retention_summary(ledger, "general_ledger", "transaction_date", as_of),
    ]
    return reduce(DataFrame.unionByName, parts)


@REGISTRY.query(
    sql_with("so", body="""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, order_status FROM so WHERE order_date < DATE '1999-08-01'""")
)
def retention_expired(spark: SparkSession, folder: str) -> DataFrame:
    orders = bindings.sales_orders(spark, folder, customer=False, profit=False)
    _, expired = governance.retention(orders, "sales_orders", "order_date", "2001-08-01")
    return expired.select("order_id", "order_date", "order_status")


_SEALED = sql_with("access", body=f"""
    , hashed AS (SELECT sha256(log_id) AS place, sha256('{{"action":"' || action || '","audit_date":"' || CAST(audit_date AS VARCHAR) || '","auditor_id":"' || auditor_id || '","entity_id":'
                        || coalesce('"' || entity_id || '"', 'null') || ',"entity_type":"' || entity_type || '","log_id":"' || log_id || '","notes":' || {_NOTES} || '}}') AS row_hash FROM access),
    two AS (SELECT 2 AS level, left(place, 2) AS prefix, CAST(COUNT(*) AS BIGINT) AS n, sha256(string_agg(row_hash, '' ORDER BY place, row_hash)) AS digest FROM hashed GROUP BY 2),
    one AS (SELECT 1 AS level, left(prefix, 1) AS prefix, CAST(SUM(n) AS BIGINT) AS n, sha256(string_agg(digest, '' ORDER BY prefix)) AS digest FROM two GROUP BY left(prefix, 1)),
    zero AS (SELECT 0 AS level, '' AS prefix, CAST(SUM(n) AS BIGINT) AS n, sha256(string_agg(digest, '' ORDER BY prefix)) AS digest FROM one)
    SELECT * FROM two UNION ALL SELECT * FROM one UNION ALL SELECT * FROM zero""")


def _whole_log(spark: SparkSession, folder: str) -> DataFrame:
    return bindings.access_log(spark, folder).withColumn("audit_date", F.col("audit_date").cast("string"))


def _sealed(spark: SparkSession, log: DataFrame, digits: int) -> sealed_log.SealedLog:
    return sealed_log.SealedLog(spark, f"{work_dir(spark)}/sealed-{uuid.uuid4().hex}").seal(log, digits)


@REGISTRY.query(_SEALED)
def log_root(spark: SparkSession, folder: str) -> DataFrame:
    """The Merkle tree over the whole log, all columns of its lines digested."""
    log = _sealed(spark, _whole_log(spark, folder), 2)
    return reduce(DataFrame.unionByName, [log.nodes(level).select(F.lit(level).alias("level"), "prefix", "n", "digest") for level in range(3)])


@REGISTRY.query(
    sql_with("access", body="""
        SELECT log_id, CASE WHEN event_id % 503 = 0 THEN 'DELETED' ELSE 'CHANGED' END AS violation FROM access WHERE event_id % 503 = 0 OR event_id % 101 = 0
        UNION ALL SELECT 'X' || log_id, 'INSERTED' FROM access WHERE event_id % 997 = 0""")
)
def log_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Changed notes, removed and inserted lines of a log, located through its tree."""
    log = _whole_log(spark, folder)
    key = F.col("log_id").cast("bigint")
    later = log.where(key % 503 != 0).withColumn("notes", F.when(key % 101 == 0, "TAMPERED").otherwise(F.col("notes")))
    added = log.where(key % 997 == 0).withColumn("log_id", F.concat(F.lit("X"), "log_id"))
    return sealed_log.differences(_sealed(spark, log, 1), _sealed(spark, later.unionByName(added), 1))
