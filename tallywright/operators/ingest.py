"""Raw order lines to the canonical tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, functions as F

from tallywright.functions import dates, money
from tallywright.functions.hashing import content_id
from tallywright.functions.text import clean
from tallywright.operators import windows
from tallywright.schemas import MONEY

# Accepted source names per canonical column, first hit wins.
ALIASES = {
    "order_id": ("Order ID", "order_id", "OrderId"),
    "order_date": ("order date (DateOrders)", "Order Date", "order_date"),
    "customer_id": ("Customer ID", "customer_id", "CustomerId"),
    "customer_name": ("Customer Name", "customer_name"),
    "customer_segment": ("Customer Segment", "customer_segment"),
    "customer_country": ("Customer Country", "customer_country", "Country"),
    "customer_city": ("Customer City", "customer_city", "City"),
    "product_id": ("Product ID", "Product Card Id", "product_id", "ProductId"),
    "product_name": ("Product Name", "product_name", "ProductName"),
    "category_name": ("Category Name", "category_name", "Category", "category"),
    "product_price": ("Sales", "sales", "Product Price", "price"),
    "order_quantity": ("Order Item Quantity", "Quantity", "quantity"),
    "sales": ("Sales", "sales"),
    "discount": ("Order Item Discount", "Discount", "discount"),
    "profit": ("Order Profit Per Order", "Profit", "profit"),
    "order_status": ("Order Status", "order_status", "OrderStatus"),
    "order_priority": ("Order Priority", "order_priority"),
    "days_for_shipment_scheduled": ("Days for shipment (scheduled)", "days_for_shipment_scheduled"),
    "days_for_shipment_real": ("Days for shipment (real)", "days_for_shipment_real"),
    "delivery_status": ("Delivery Status", "delivery_status"),
    "late_delivery_risk": ("Late_delivery_risk", "late_delivery_risk"),
    "shipping_mode": ("Shipping Mode", "shipping_mode", "Type"),
    "shipping_date": ("shipping date (DateOrders)", "Shipping Date", "shipping_date"),
    "market": ("Market",),
    "region": ("Region",),
}

MONEY_COLUMNS = ("sales", "discount", "profit")
WHOLE_COLUMNS = (
    "order_quantity",
    "days_for_shipment_scheduled",
    "days_for_shipment_real",
    "late_delivery_risk",
)
DATE_COLUMNS = ("order_date", "shipping_date")
DUE_AFTER_DAYS = 30


def find_column(columns: list[str], names: tuple[str, ...]) -> str | None:
    """First name of the list that occurs, whatever its case and outer blanks."""
    present: dict[str, str] = {}
    for column in columns:
        present.setdefault(column.strip().lower(), column)
    return next((present[n.strip().lower()] for n in names if n.strip().lower() in present), None)


def harmonise(raw: DataFrame, aliases: dict[str, tuple[str, ...]] = ALIASES, seq: str = "seq") -> DataFrame:
    """Canonical names, cleaned text, NULL for columns the source lacks.

    ``customer_key`` is the customer id, or the order id where the source has no
    customer column.  ``seq`` (input order) passes through untouched.
    """
    sources = {canon: find_column(raw.columns, names) for canon, names in aliases.items()}
    if sources.get("order_id") is None:
        raise ValueError("the extract has no order id column")

    def text_of(name: str | None) -> Column:
        return clean(name) if name else F.lit(None).cast("string")

    picked = [text_of(source).alias(canon) for canon, source in sources.items()]
    key = text_of(sources.get("customer_id") or sources["order_id"]).alias("customer_key")
    kept = [F.col(seq)] if seq in raw.columns else []
    return raw.select(*picked, key, *kept)


def _conversions() -> dict[str, Column]:
    """What the text columns become, without defaults."""
    typed = {c: money.to_money(F.col(c)) for c in MONEY_COLUMNS}
    typed |= {c: money.to_whole(F.col(c)) for c in WHOLE_COLUMNS}
    typed |= {c: dates.parse_date(F.col(c)) for c in DATE_COLUMNS}
    return typed | {"product_price": money.to_money(F.col("product_price"))}


def _converted(lines: DataFrame, lenient: Iterable[str] = ()) -> tuple[DataFrame, Column]:
    """``lines`` with all conversions in ``_as``, and the reason to reject a row (NULL for none).

    A one-element explode keeps every row, and what is built on its result stays above it; a plain
    column would be copied into filters and projections, and all conversions run again.
    """
    typed = _conversions()
    both = lines.withColumn("_as", F.explode(F.array(F.struct(*[value.alias(c) for c, value in typed.items()]))))
    problems = [F.when(F.col("order_id").isNull(), F.lit("order_id missing"))]
    for column in typed:
        lost = F.col(column).isNotNull() & F.col(f"_as.{column}").isNull()
        if column == "product_price":  # where sales stand in for the price, they are named once
            lost = lost & ~F.col(column).eqNullSafe(F.col("sales"))
        if column not in lenient:
            problems.append(F.when(lost, F.lit(f"{column} unreadable")))
    return both, F.nullif(F.concat_ws("; ", *problems), F.lit(""))


def with_reject_reason(lines: DataFrame, lenient: Iterable[str] = ()) -> DataFrame:
    """Add ``reject_reason``: NULL for rows that convert, else the columns at fault.

    A row lacks its order id, or holds an amount, number, price or date that does not read.  Columns
    named in ``lenient`` are not judged; what does not read in them becomes NULL.
    """
    both, reason = _converted(lines, lenient)
    return both.select(*lines.columns, reason.alias("reject_reason"))


def split_rejects(lines: DataFrame, lenient: Iterable[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows that convert, and the others with their reason; together the whole input."""
    marked = with_reject_reason(lines, lenient)
    good = marked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.where(F.col("reject_reason").isNotNull())


def judged_lines(lines: DataFrame, lenient: Iterable[str] = ()) -> DataFrame:
    """All harmonised rows, converted once: typed columns, ``reject_reason`` and, for rejects, the
    texts as they came in ``told``."""
    both, reason = _converted(lines, lenient)
    marked = both.withColumn("reject_reason", reason)
    told = F.when(F.col("reject_reason").isNotNull(), F.struct(*_conversions()))
    return marked.withColumn("told", told).withColumns(_defaults(lambda c: F.col(f"_as.{c}"))).drop("_as")


def accepted_lines(judged: DataFrame) -> DataFrame:
    """The typed rows that convert."""
    return judged.where(F.col("reject_reason").isNull()).drop("reject_reason", "told")


def rejected_lines(judged: DataFrame) -> DataFrame:
    """The other rows, as they came, with ``reject_reason``."""
    texts = {c: F.col(f"told.{c}") for c in _conversions()}
    return judged.where(F.col("reject_reason").isNotNull()).withColumns(texts).drop("told")


def typed_lines(lines: DataFrame) -> DataFrame:
    """Harmonised text rows with their canonical types and defaults, one row per line."""
    return lines.withColumns(_defaults(_conversions().__getitem__))


def _defaults(value: Callable[[str], Column]) -> dict[str, Column]:
    """Converted columns with 0 for missing amounts, quantities and flags.  A missing price stays
    missing: it says nothing about a product's mean price."""
    zero = F.lit(0).cast(MONEY)
    whole = {c: F.coalesce(value(c), F.lit(0)) for c in ("order_quantity", "late_delivery_risk")}
    return {c: value(c) for c in _conversions()} | {c: F.coalesce(value(c), zero) for c in MONEY_COLUMNS} | whole


def _stamp(loaded_at: str | None) -> Column:
    return F.lit(loaded_at).cast("timestamp")


def build_sales_orders(
    lines: DataFrame, seq: str = "seq", loaded_at: str | None = None, sum_lines: bool = False
) -> DataFrame:
    """One row per order: its last line, or with ``sum_lines`` the sums of all lines."""
    flat = lines.select(
        "order_id",
        "order_date",
        F.col("customer_key").alias("customer_id"),
        "customer_name",
        "customer_segment",
        "customer_country",
        "customer_city",
        "product_id",
        "product_name",
        "category_name",
        "order_quantity",
        *MONEY_COLUMNS,
        "order_status",
        "order_priority",
        "days_for_shipment_scheduled",
        "days_for_shipment_real",
        "delivery_status",
        "late_delivery_risk",
        seq,
    )
    if sum_lines:
        summed = ("order_quantity", *MONEY_COLUMNS)
        rest = [c for c in flat.columns if c not in ("order_id", seq, *summed)]
        orders = (
            flat.groupBy("order_id")
            .agg(
                F.max_by(F.struct(*rest), seq).alias("_row"),
                F.sum("order_quantity").cast("int").alias("order_quantity"),
                *(F.sum(c).cast(MONEY).alias(c) for c in MONEY_COLUMNS),
            )
            .select("order_id", "_row.*", *summed)
        )
    else:
        orders = windows.keep_last(flat, "order_id", seq)
    day = F.col("order_date")
    return orders.select(
        "order_id",
        "order_date",
        "customer_id",
        "customer_name",
        "customer_segment",
        "customer_country",
        "customer_city",
        "product_id",
        "product_name",
        "category_name",
        "order_quantity",
        *MONEY_COLUMNS,
        "order_status",
        "order_priority",
        F.year(day).alias("order_year"),
        F.month(day).alias("order_month"),
        F.dayofmonth(day).alias("order_day"),
        "days_for_shipment_scheduled",
        "days_for_shipment_real",
        "delivery_status",
        "late_delivery_risk",
        _stamp(loaded_at).alias("created_at"),
    )


def build_products(lines: DataFrame, seq: str = "seq", loaded_at: str | None = None) -> DataFrame:
    """Products with the name and category seen first and their mean price: that of the sales, or
    of the source's own price column where it has no sales."""
    known = lines.where(F.col("product_id").isNotNull())
    return (
        known.groupBy("product_id")
        .agg(
            F.min_by(F.struct("product_name", "category_name"), seq).alias("_first"),
            F.avg("product_price").cast(MONEY).alias("product_price"),
        )
        .select(
            "product_id",
            F.col("_first.product_name").alias("product_name"),
            F.col("_first.category_name").alias("product_category"),
            "product_price",
            F.lit(None).cast(MONEY).alias("product_cost"),
            F.lit(None).cast(MONEY).alias("product_margin"),
            _stamp(loaded_at).alias("created_at"),
        )
    )


#: Columns of a line that its shipment and its ledger entries are made of.
SHIPPING_COLUMNS = (
    "order_id",
    "shipping_mode",
    "shipping_date",
    "days_for_shipment_scheduled",
    "days_for_shipment_real",
    "delivery_status",
    "late_delivery_risk",
    "customer_country",
    "customer_city",
    "market",
    "region",
)
LEDGER_COLUMNS = ("order_id", "order_date", "sales", "profit")


def numbered_lines(lines: DataFrame, seq: str = "seq", keep: Iterable[str] | None = None) -> DataFrame:
    """All lines with a ``line_id`` in place of ``seq``, for keys that are stored.

    The id is made of the digest of the line's whole content and its number among identical lines, so
    it depends neither on files, splits nor the order of reading.  Identical lines are counted (with
    partial counts before the shuffle) and then repeated.  ``keep`` names the columns that are needed
    later; no others are shuffled.
    """
    told = sorted(c for c in lines.columns if c != seq)
    kept = told if keep is None else [c for c in told if c in set(keep)]
    counted = lines.groupBy(content_id(*told).alias("_digest"), *kept).agg(F.count("*").alias("_times"))
    each = counted.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return each.select(*kept, content_id("_digest", "_nth").alias("line_id"))


def build_shipping_logs(lines: DataFrame, seq: str = "line_id", loaded_at: str | None = None) -> DataFrame:
    """One row per line of :func:`numbered_lines`.  The ship date is the source's own or NULL,
    never the order date."""
    return lines.select(
        content_id(F.lit("SHIP"), "order_id", seq).alias("log_id"),
        *SHIPPING_COLUMNS,
        _stamp(loaded_at).alias("created_at"),
    )


def build_general_ledger(lines: DataFrame, seq: str = "line_id", loaded_at: str | None = None) -> DataFrame:
    """Per line of :func:`numbered_lines` a revenue credit and, where the cost is positive, a cost debit."""
    cost = (F.col("sales") - F.col("profit")).cast(MONEY)
    zero = F.lit(0).cast(MONEY)
    # Only the code is repeated, by an expression that is compiled; arrays of whole entries are not.
    codes = F.when(cost > 0, F.array(F.lit("4000"), F.lit("5000"))).otherwise(F.array(F.lit("4000")))
    revenue = F.col("account_code") == "4000"
    label = F.when(revenue, "Sales for Order ").otherwise("COGS for Order ")
    return lines.select("order_id", "order_date", seq, "sales", "profit", F.explode(codes).alias("account_code")).select(
        content_id(F.lit("GL"), "order_id", seq, "account_code").alias("entry_id"),
        F.col("order_date").alias("transaction_date"),
        "order_id",
        "account_code",
        F.when(revenue, "Sales Revenue").otherwise("Cost of Goods Sold").alias("account_name"),
        F.when(revenue, zero).otherwise(cost).alias("debit_amount"),
        F.when(revenue, F.col("sales").cast(MONEY)).otherwise(zero).alias("credit_amount"),
        F.concat(label, F.col("order_id")).alias("description"),
        F.col("order_id").alias("reference_number"),
        _stamp(loaded_at).alias("created_at"),
    )


def payment_status(status: Column, case_insensitive: bool = False) -> Column:
    """Paid, Cancelled or Outstanding by what the order status contains."""
    text = F.coalesce(status, F.lit("Unknown"))
    paid, dead = text.contains("Complete"), text.contains("Cancel")
    if case_insensitive:
        paid, dead = F.lower(text).contains("complete"), F.lower(text).contains("cancel")
    return F.when(paid, "Paid").when(dead, "Cancelled").otherwise("Outstanding")


def receivables_of(orders: DataFrame, case_insensitive: bool = False, loaded_at: str | None = None) -> DataFrame:
    """Receivables of typed orders: due 30 days after the order, settled by its status."""
    amount = F.col("sales").cast(MONEY)
    zero = F.lit(0).cast(MONEY)
    state = payment_status(F.col("order_status"), case_insensitive)
    return orders.select(
        content_id(F.lit("AR"), "order_id").alias("ar_id"),
        "order_id",
        "customer_id",
        "customer_name",
        F.col("order_date").alias("invoice_date"),
        F.date_add("order_date", DUE_AFTER_DAYS).alias("due_date"),
        amount.alias("invoice_amount"),
        F.when(state == "Paid", amount).otherwise(zero).alias("paid_amount"),
        F.when(state == "Outstanding", amount).otherwise(zero).alias("outstanding_amount"),
        state.alias("payment_status"),
        F.lit(0).alias("days_past_due"),
        _stamp(loaded_at).alias("created_at"),
        _stamp(loaded_at).alias("updated_at"),
    )


def build_accounts_receivable(
    lines: DataFrame, seq: str = "seq", case_insensitive: bool = False, loaded_at: str | None = None
) -> DataFrame:
    """Receivables of raw lines, the last line of an order deciding."""
    picked = lines.select("order_id", "customer_id", "customer_name", "order_date", "sales", "order_status", seq)
    return receivables_of(windows.keep_last(picked, "order_id", seq), case_insensitive, loaded_at)
