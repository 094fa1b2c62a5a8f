"""Canonical views over the given tables.

The tables have no finance side and no status words, so both are derived by fixed
rules on the order key.  Money is cast factor by factor: a finished DOUBLE product
would round ties differently from engine to engine.  Each view only joins what its
caller asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tallywright.functions.hashing import content_id
from tallywright.operators import ingest, joins
from tallywright.schemas import MONEY

GHOST_OFFSET = 100_000_000
#: Columns that tell the shipments of an order apart.
SHIPMENT = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


def _schema(**kinds: str) -> StructType:
    names = {
        "long": LongType(),
        "int": IntegerType(),
        "double": DoubleType(),
        "string": StringType(),
        "time": TimestampNTZType(),
    }
    return StructType([StructField(name, names[kind]) for name, kind in kinds.items()])


# Stated, so that no read starts with a job of its own to look the schema up.
SCHEMAS = {
    "nation": _schema(n_nationkey="int", n_name="string", n_regionkey="int"),
    "customer": _schema(
        c_custkey="long", c_name="string", c_nationkey="int", c_acctbal="double", c_mktsegment="string"
    ),
    "part": _schema(
        p_partkey="long", p_name="string", p_brand="string", p_type="string", p_size="int", p_retailprice="double"
    ),
    "orders": _schema(
        o_orderkey="long",
        o_custkey="long",
        o_orderstatus="string",
        o_totalprice="double",
        o_orderdate="time",
        o_orderpriority="string",
    ),
    "lineitem": _schema(
        l_orderkey="long",
        l_partkey="long",
        l_suppkey="long",
        l_linenumber="int",
        l_quantity="double",
        l_extendedprice="double",
        l_discount="double",
        l_tax="double",
        l_returnflag="string",
        l_linestatus="string",
        l_shipdate="time",
    ),
    "events": _schema(
        event_id="long", ts="time", user_id="long", event_type="string", value="double", props="string"
    ),
}

def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _status(key: Column, code: Column) -> Column:
    return (
        F.when(key % 97 == 0, "SUSPECTED_FRAUD")
        .when(code == "P", "CANCELED")
        .when(code == "F", "COMPLETE")
        .otherwise("PROCESSING")
    )


def line_profit() -> Column:
    """Discounted price minus quantity at list price, exact to 4 digits."""
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kept = F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)")
    cost = F.col("l_quantity").cast("decimal(7,2)") * F.col("p_retailprice").cast("decimal(9,2)")
    return (price * kept - cost).cast("decimal(18,4)")


def order_columns(orders: DataFrame) -> DataFrame:
    """Canonical order columns of the orders table itself, batch or stream."""
    key = F.col("o_orderkey")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        key.cast("string").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").cast(MONEY).alias("sales"),
        _status(key, F.col("o_orderstatus")).alias("order_status"),
        F.col("o_orderpriority").alias("order_priority"),
    )


def sales_orders(
    spark: SparkSession, folder: str, customer: bool = True, profit: bool = True
) -> DataFrame:
    """One row per order, with customer columns and profit on request."""
    orders = order_columns(table(spark, folder, "orders"))
    if customer:
        people = table(spark, folder, "customer").select(
            F.col("c_custkey").alias("o_custkey"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("customer_segment"),
            F.col("c_nationkey").alias("n_nationkey"),
        )
        nation = table(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("customer_country"))
        orders = joins.join_to_unique(orders, people, "o_custkey", "left")
        orders = joins.join_to_unique(orders, nation, "n_nationkey", "left").drop("n_nationkey")
    else:
        orders = orders.withColumn("customer_name", F.lit(None).cast("string"))
    if profit:
        prices = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
        lines = table(spark, folder, "lineitem").select(
            "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount"
        )
        earned = (
            joins.join_to_unique(lines, prices, "l_partkey")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(F.sum(line_profit()).alias("profit"))
        )
        orders = orders.join(earned, "o_orderkey", "left").withColumn(
            "profit", F.coalesce(F.col("profit").cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))
        )
    return orders.drop("o_orderkey", "o_custkey")


def shipping_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The order lines as shipments, with the columns that :func:`shipment_id` is made of."""
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_shipdate").cast("date").alias("shipping_date"),
        *SHIPMENT,
    )


def shipment_id() -> Column:
    """The id of a shipment, which may be made after a join: it is wider than what it is made of."""
    return content_id(
        F.lit("SHIP"),
        "order_id",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("int"),
        F.date_format("l_shipdate", "yyyy-MM-dd"),
    )


def shipping_logs(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line."""
    return shipping_lines(spark, folder).select(shipment_id().alias("log_id"), "order_id", "shipping_date")


def invoice_columns(orders: DataFrame) -> DataFrame:
    """Invoices of the orders table, batch or stream: most orders have one, some are off
    in amount or date, and ghosts belong to no order."""
    key = F.col("o_orderkey")
    ids = F.array_compact(
        F.array(F.when(key % 50 != 0, key), F.when(key % 101 == 0, key + F.lit(GHOST_OFFSET)))
    )
    total = F.col("o_totalprice").cast(MONEY)
    late = F.when(key % 29 == 0, 3).when(key % 7 == 0, 1).otherwise(0)
    state = (
        F.when(key % 113 == 0, "Cancelled").when(F.col("o_orderstatus") == "F", "Paid").otherwise("Outstanding")
    )
    return orders.withColumn("_id", F.explode(ids)).select(
        "o_custkey",
        F.col("_id").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.date_add(F.col("o_orderdate").cast("date"), late).alias("invoice_date"),
        F.when(key % 37 == 0, total + F.lit(5)).otherwise(total).cast(MONEY).alias("invoice_amount"),
        state.alias("payment_status"),
    )


def accounts_receivable(spark: SparkSession, folder: str, customer: bool = False) -> DataFrame:
    """:func:`invoice_columns` with the derived amounts, with customer names on request."""
    rows = invoice_columns(table(spark, folder, "orders"))
    if customer:
        people = table(spark, folder, "customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("customer_name")
        )
        rows = joins.join_to_unique(rows, people, "o_custkey", "left")
    else:
        rows = rows.withColumn("customer_name", F.lit(None).cast("string"))
    zero = F.lit(0).cast(MONEY)
    amount, settled = F.col("invoice_amount"), F.col("payment_status")
    return rows.select(
        content_id(F.lit("AR"), "order_id").alias("ar_id"),
        "order_id",
        "customer_id",
        "customer_name",
        "invoice_date",
        F.date_add("invoice_date", ingest.DUE_AFTER_DAYS).alias("due_date"),
        "invoice_amount",
        F.when(settled == "Paid", amount).otherwise(zero).alias("paid_amount"),
        F.when(settled == "Outstanding", amount).otherwise(zero).alias("outstanding_amount"),
        "payment_status",
        F.lit(0).alias("days_past_due"),
    )


def raw_extract(spark: SparkSession, folder: str, product: bool = True, customer: bool = True) -> DataFrame:
    """Order lines as a raw text extract, with some unreadable cells and missing ids."""
    lines = table(spark, folder, "lineitem")
    key = F.col("l_orderkey")
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority"
    )
    # Two large tables: sorted by key on both sides at every size, which also deals the lines of a file
    # with few row groups to all cores before their text is made and parsed.
    rows = joins.join_to_unique(lines, orders.hint("merge"), "l_orderkey")
    if product:
        parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type", "p_retailprice")
        rows = joins.join_to_unique(rows, parts, "l_partkey")
        product_columns = [
            F.col("p_name").alias("Product Name"),
            F.col("p_type").alias("Category Name"),
            line_profit().cast(MONEY).cast("string").alias("Order Profit Per Order"),
        ]
    else:
        product_columns = []
    if customer:
        people = table(spark, folder, "customer").select(
            F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
        )
        rows = joins.join_to_unique(rows, people, "o_custkey", "left")
        customer_columns = [F.col("c_name").alias(" customer name "), F.col("c_mktsegment").alias("Customer Segment")]
    else:
        customer_columns = []
    status = (
        F.when(F.col("o_orderstatus") == "F", "Complete")
        .when(F.col("o_orderstatus") == "P", "Cancelled")
        .otherwise("nan")
    )
    return rows.select(
        F.when(key % 227 != 0, key.cast("string")).alias("Order ID"),
        F.when(key % 223 == 0, "99/99/9999")
        .otherwise(F.date_format("o_orderdate", "M/d/yyyy H:mm"))
        .alias("order date (DateOrders)"),
        F.col("o_custkey").cast("string").alias("CUSTOMER ID"),
        F.col("l_partkey").cast("string").alias("Product Card Id"),
        F.when(key % 211 == 0, "abc").otherwise(F.col("l_quantity").cast("string")).alias("Order Item Quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("string").alias("Sales"),
        F.col("l_discount").cast("decimal(3,2)").cast("string").alias("Order Item Discount"),
        status.alias("Order Status"),
        F.col("o_orderpriority").alias("Order Priority"),
        F.date_format("l_shipdate", "M/d/yyyy H:mm").alias("shipping date (DateOrders)"),
        F.when(F.col("l_shipdate") > F.col("o_orderdate"), "1").otherwise("0").alias("Late_delivery_risk"),
        F.col("l_linestatus").alias("Type"),
        *product_columns,
        *customer_columns,
        F.struct("l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice").alias("seq"),
    )


def erp_orders(spark: SparkSession, folder: str, system: str) -> DataFrame:
    """Orders as an ERP system would deliver them."""
    orders = table(spark, folder, "orders")
    key, code = F.col("o_orderkey"), F.col("o_orderstatus")
    amount = F.col("o_totalprice").cast(MONEY)
    if system == "sap":
        state = F.when(key % 17 == 0, "X").when(code == "P", "D").when(code == "F", "C").when(key % 3 == 0, "A").otherwise("B")
        return orders.select(
            F.lpad(key.cast("string"), 10, "0").alias("VBELN"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("AUDAT"),
            F.lpad(F.col("o_custkey").cast("string"), 10, "0").alias("KUNNR"),
            (amount * 100).cast("decimal(20,0)").cast("string").alias("NETWR"),
            F.lit("USD").alias("WAERK"),
            state.alias("GBSTK"),
            F.col("o_orderpriority").alias("PRIO"),
        )
    state = (
        F.when(key % 17 == 0, "ON_HOLD")
        .when(code == "P", "CANCELLED")
        .when(code == "F", "CLOSED")
        .when(key % 3 == 0, "ENTERED")
        .otherwise("BOOKED")
    )
    return orders.select(
        key.cast("string").alias("OrderNumber"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("OrderedDate"),
        F.col("o_custkey").cast("string").alias("SoldToOrgId"),
        amount.cast("string").alias("LineTotal"),
        F.lit("USD").alias("CurrencyCode"),
        state.alias("FlowStatusCode"),
    )


def ledger_feed(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions of a finance feed, several per order, some off and some unknown."""
    lines = table(spark, folder, "lineitem")
    key = F.col("l_orderkey")
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    total = F.col("o_totalprice").cast(MONEY)
    number = F.col("l_linenumber")
    amount = F.when(number % 5 == 0, total + F.lit(1).cast(MONEY)).when(number % 7 == 0, total + F.lit("0.01").cast(MONEY)).otherwise(total)
    return joins.join_to_unique(lines, orders.hint("merge"), "l_orderkey").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("transaction_id"),
        F.when(key % 19 == 0, F.concat(F.lit("X"), key.cast("string"))).otherwise(key.cast("string")).alias("order_id"),
        amount.cast(MONEY).alias("amount"),
    )


def export_feed(spark: SparkSession, folder: str) -> DataFrame:
    """A transaction export: refunds below zero, some account codes missing."""
    key = F.col("o_orderkey")
    total = F.col("o_totalprice").cast(MONEY)
    return table(spark, folder, "orders").select(
        key.alias("row"),
        F.concat(F.lit("TXN"), key.cast("string")).alias("transaction_id"),
        F.when(key % 31 == 0, -total).otherwise(total).cast(MONEY).alias("amount"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(key % 41 != 0, F.when(F.col("o_orderstatus") == "P", "2000").otherwise("1000")).alias("account_code"),
    )


def access_log(spark: SparkSession, folder: str) -> DataFrame:
    """Who touched what and when, as audit log lines."""
    kind = F.col("event_type")
    action = (
        F.when(kind == "signup", "ROLE_GRANT")
        .when(kind == "error", "PERMISSION_DENIED")
        .when(kind == "purchase", "EXPORT")
        .otherwise("READ")
    )
    return table(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("log_id"),
        F.col("ts").alias("audit_date"),
        F.col("user_id").cast("string").alias("auditor_id"),
        action.alias("action"),
        kind.alias("entity_type"),
        F.get_json_object("props", "$.k").alias("entity_id"),
        F.col("props").alias("notes"),
    )


def sync_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One sync run per event type, table and day."""
    runs = table(spark, folder, "events").groupBy(
        F.col("event_type").alias("system"),
        F.when(F.col("user_id") % 2 == 0, "sales_orders").otherwise("accounts_receivable").alias("table_name"),
        F.date_trunc("day", "ts").alias("run_ts"),
    )
    peak = F.max("value")
    return runs.agg(F.count("*").alias("record_count"), peak.alias("peak")).select(
        "system",
        "table_name",
        "run_ts",
        "record_count",
        (F.col("peak") / 20).alias("latency_minutes"),
        (F.col("peak") / 10).alias("response_seconds"),
        (F.col("peak") > 200).alias("failed"),
    )


def risk_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags with the time they took to settle, from the error events."""
    events = table(spark, folder, "events").where(F.col("event_type") == "error")
    raised = F.col("ts").cast("timestamp")
    hours = F.expr("make_dt_interval(0, cast(event_id % 72 as int), 0, 0)")
    return events.select(
        F.col("event_id").cast("string").alias("flag_id"),
        raised.alias("flag_date"),
        F.when(F.col("event_id") % 4 != 0, raised + hours).alias("resolved_at"),
    )
