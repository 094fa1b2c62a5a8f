"""Column lists of the canonical tables.

Money is DECIMAL(18,2); identifiers stay text; missing values are NULL only.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

MONEY = "decimal(18,2)"

_KINDS = {
    "string": StringType(),
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "money": DecimalType(18, 2),
    "date": DateType(),
    "timestamp": TimestampType(),
}


def _columns(**kinds: str) -> StructType:
    return StructType([StructField(name, _KINDS[kind]) for name, kind in kinds.items()])


SALES_ORDERS = _columns(
    order_id="string", order_date="date", customer_id="string", customer_name="string",
    customer_segment="string", customer_country="string", customer_city="string", product_id="string",
    product_name="string", category_name="string", order_quantity="int", sales="money", discount="money",
    profit="money", order_status="string", order_priority="string", order_year="int", order_month="int",
    order_day="int", days_for_shipment_scheduled="int", days_for_shipment_real="int",
    delivery_status="string", late_delivery_risk="int", created_at="timestamp",
)

PRODUCTS = _columns(
    product_id="string", product_name="string", product_category="string", product_price="money",
    product_cost="money", product_margin="money", created_at="timestamp",
)

SHIPPING_LOGS = _columns(
    log_id="string", order_id="string", shipping_mode="string", shipping_date="date",
    days_for_shipment_scheduled="int", days_for_shipment_real="int", delivery_status="string",
    late_delivery_risk="int", customer_country="string", customer_city="string", market="string",
    region="string", created_at="timestamp",
)

GENERAL_LEDGER = _columns(
    entry_id="string", transaction_date="date", order_id="string", account_code="string",
    account_name="string", debit_amount="money", credit_amount="money", description="string",
    reference_number="string", created_at="timestamp",
)

ACCOUNTS_RECEIVABLE = _columns(
    ar_id="string", order_id="string", customer_id="string", customer_name="string", invoice_date="date",
    due_date="date", invoice_amount="money", paid_amount="money", outstanding_amount="money",
    payment_status="string", days_past_due="int", created_at="timestamp", updated_at="timestamp",
)

AUDIT_LOGS = _columns(
    log_id="string", audit_date="timestamp", audit_type="string", source_system="string",
    entity_type="string", entity_id="string", action="string", old_value="string", new_value="string",
    auditor_id="string", auditor_name="string", notes="string", risk_level="string", status="string",
)

RISK_FLAGS = _columns(
    flag_id="string", flag_date="timestamp", risk_type="string", severity="string", entity_type="string",
    entity_id="string", description="string", source_system="string", status="string", assigned_to="string",
    resolution_notes="string", resolved_at="timestamp", created_at="timestamp",
)

FRAUD_RULE_METRICS = _columns(
    metric_id="string", evaluation_date="timestamp", rule_type="string", evaluation_period="string",
    true_positives="bigint", false_positives="bigint", true_negatives="bigint", false_negatives="bigint",
    precision="double", recall="double", f1_score="double", false_positive_rate="double",
    false_negative_rate="double", accuracy="double", threshold_config="string", notes="string",
)

RECONCILIATION_AUDIT = _columns(
    audit_id="string", audit_date="timestamp", reconciliation_period="string", total_ops_records="bigint",
    total_fin_records="bigint", matched_records="bigint", orphan_ops_count="bigint",
    orphan_fin_count="bigint", amount_mismatch_count="bigint", executed_by="string",
    execution_status="string", notes="string",
)

# Narrow transaction export: four required columns, description optional.
ERP_EXPORT = _columns(
    transaction_id="string", amount="money", date="date", account_code="string", description="string",
)
EXPORT_REQUIRED = ("transaction_id", "amount", "date", "account_code")

OPERATIONS_SAMPLE = _columns(
    order_id="string", date="date", order_status="string", sales="money", customer_name="string",
)
FINANCE_SAMPLE = _columns(
    transaction_id="string", date="date", order_id="string", amount="money", currency="string",
    gl_account="string", status="string",
)

STORES = {
    "operations": {
        "products": PRODUCTS,
        "sales_orders": SALES_ORDERS,
        "shipping_logs": SHIPPING_LOGS,
    },
    "finance": {
        "general_ledger": GENERAL_LEDGER,
        "accounts_receivable": ACCOUNTS_RECEIVABLE,
    },
    "audit": {
        "audit_logs": AUDIT_LOGS,
        "risk_flags": RISK_FLAGS,
        "fraud_rule_metrics": FRAUD_RULE_METRICS,
        "reconciliation_audit": RECONCILIATION_AUDIT,
    },
}
