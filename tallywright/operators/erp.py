"""Field names, types and status codes of the supported ERP systems."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from tallywright.functions import dates, money
from tallywright.functions.text import strip_leading_zeros

# Source field to canonical column, per system and table.
FIELD_MAPS = {
    "sap": {
        "sales_orders": {
            "VBELN": "order_id",
            "AUDAT": "order_date",
            "KUNNR": "customer_id",
            "NAME1": "customer_name",
            "MATNR": "product_id",
            "MAKTX": "product_name",
            "KWMENG": "order_quantity",
            "NETWR": "sales",
            "WAERK": "currency",
            "GBSTK": "order_status",
            "WADAT": "shipping_date",
        },
        "accounts_receivable": {
            "BELNR": "document_id",
            "VBELN": "order_id",
            "KUNNR": "customer_id",
            "BLDAT": "invoice_date",
            "DMBTR": "invoice_amount",
            "WRBTR": "amount_local_currency",
            "AUGDT": "clearing_date",
            "AUGBL": "clearing_document",
        },
    },
    "oracle": {
        "sales_orders": {
            "ORDER_NUMBER": "order_id",
            "ORDERED_DATE": "order_date",
            "SOLD_TO_ORG_ID": "customer_id",
            "CUSTOMER_NAME": "customer_name",
            "INVENTORY_ITEM_ID": "product_id",
            "ORDERED_QUANTITY": "order_quantity",
            "UNIT_SELLING_PRICE": "unit_price",
            "LINE_TOTAL": "sales",
            "CURRENCY_CODE": "currency",
            "FLOW_STATUS_CODE": "order_status",
        },
        "accounts_receivable": {
            "CUSTOMER_TRX_ID": "invoice_id",
            "TRX_NUMBER": "invoice_number",
            "TRX_DATE": "invoice_date",
            "BILL_TO_CUSTOMER_ID": "customer_id",
            "INVOICE_CURRENCY_CODE": "currency",
            "EXCHANGE_RATE": "exchange_rate",
            "TOTAL_LINE_AMOUNT": "invoice_amount",
            "AMOUNT_DUE_REMAINING": "outstanding_amount",
        },
    },
}

# Status codes of the sources.
STATUS_MAPS = {
    "sap": {"A": "NEW", "B": "PROCESSING", "C": "COMPLETE", "D": "CANCELED"},
    "oracle": {"ENTERED": "NEW", "BOOKED": "PROCESSING", "CLOSED": "COMPLETE", "CANCELLED": "CANCELED"},
}

Extra = Mapping[str, str | tuple[str, Callable[[Column], Column]]]


def _plain(name: str) -> str:
    """``ORDER_NUMBER`` and ``OrderNumber`` read alike."""
    return name.replace("_", "").lower()


def apply_mapping(df: DataFrame, system: str, table: str, extra: Extra | None = None) -> DataFrame:
    """Rename source fields to canonical names; other fields pass through.

    ``extra`` maps further fields: source name to target, or to a pair of target
    and a function on the column.
    """
    try:
        fields = FIELD_MAPS[system][table]
    except KeyError:
        raise ValueError(f"no field map for {system}.{table}") from None
    targets = {_plain(source): target for source, target in fields.items()}
    extra = dict(extra or {})
    changed, columns = {_plain(source): rule for source, rule in extra.items()}, []
    for column in df.columns:
        rule = changed.get(_plain(column), targets.get(_plain(column), column))
        target, transform = rule if isinstance(rule, tuple) else (rule, None)
        value = F.col(f"`{column}`")
        columns.append((transform(value) if transform else value).alias(target))
    return df.select(*columns)


def convert_types(df: DataFrame, amounts_in_cents: bool = False) -> DataFrame:
    """Dates, amounts, quantities and ids of mapped text fields to canonical types.

    ``amounts_in_cents`` divides amounts by 100, as some extracts ship them whole.
    """
    typed: dict[str, Column] = {}
    for column in df.columns:
        value = F.col(column)
        if column.endswith("_date"):
            typed[column] = dates.parse_date(value.cast("string"))
        elif column in ("sales", "unit_price", "invoice_amount", "outstanding_amount", "amount_local_currency"):
            whole = value.try_cast("decimal(20,2)") * F.lit(Decimal("0.01")) if amounts_in_cents else value
            typed[column] = money.to_money(whole)
        elif column == "order_quantity":
            typed[column] = money.to_whole(value)
        elif column in ("customer_id", "order_id", "product_id"):
            typed[column] = strip_leading_zeros(value.cast("string"))
    return df.withColumns(typed) if typed else df


def map_status(df: DataFrame, system: str, column: str = "order_status") -> DataFrame:
    """Canonical status; an unknown code stays and is flagged in ``status_unmapped``."""
    codes = STATUS_MAPS[system]
    lookup = F.create_map(*(F.lit(x) for pair in codes.items() for x in pair))
    known = F.col(column).isin(*codes)
    return df.withColumns(
        {
            column: F.when(known, F.try_element_at(lookup, F.col(column))).otherwise(F.col(column)),
            "status_unmapped": F.col(column).isNotNull() & ~known,
        }
    )


def from_erp(
    df: DataFrame, system: str, table: str, extra: Extra | None = None, amounts_in_cents: bool = False
) -> DataFrame:
    """Mapping, types and, for orders, status codes in one go."""
    mapped = convert_types(apply_mapping(df, system, table, extra), amounts_in_cents)
    return map_status(mapped, system) if "order_status" in mapped.columns else mapped


def judged(df: DataFrame, system: str, table: str, extra: Extra | None = None, amounts_in_cents: bool = False) -> DataFrame:
    """All rows of an extract in canonical columns, types and status codes, with ``reject_reason`` (NULL
    for rows that convert) and, for rejects, the mapped fields as they came in ``told``.

    A row is rejected for a date, amount or quantity that does not read, and an order for lacking its id.
    """
    told = apply_mapping(df, system, table, extra)
    both = convert_types(told.withColumn("_told", F.struct(*told.columns)), amounts_in_cents)
    came = {c: F.col(f"_told.{c}").cast("string") for c in told.columns}
    lost = [F.when((F.trim(came[c]) != "") & F.col(c).isNull(), F.lit(f"{c} unreadable")) for c in told.columns]
    if table == "sales_orders" and "order_id" in came:
        lost.insert(0, F.when(F.coalesce(F.trim(came["order_id"]), F.lit("")) == "", F.lit("order_id missing")))
    marked = both.withColumn("reject_reason", F.nullif(F.concat_ws("; ", *lost), F.lit("")))
    if "order_status" in told.columns:
        marked = map_status(marked, system)
    return marked.withColumn("told", F.when(F.col("reject_reason").isNotNull(), F.col("_told"))).drop("_told")


def rejects(df: DataFrame, system: str, table: str, extra: Extra | None = None, amounts_in_cents: bool = False) -> DataFrame:
    """The rejected rows of :func:`judged`: the mapped fields as they came and ``reject_reason``."""
    return judged(df, system, table, extra, amounts_in_cents).where(F.col("reject_reason").isNotNull()).select("told.*", "reject_reason")


def combine(extracts: Mapping[str, DataFrame], key: str, changed: str, prefer: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """One row a key from the canonical rows of several systems, each field with the system it comes from.

    Of the systems that have a field, the one with the newest ``changed`` gives it, of equally new ones the
    earlier in ``extracts``.  ``prefer`` names fields for which an order of systems goes before recency.
    Further rows of a system compete in the same way; of equals the greater value wins.  Rows without a
    key are left out, a row never changed comes last.  ``<field>_from`` tells the system, ``systems`` all
    that know the key.  Tasks send one row a key.
    """
    prefer, known = dict(prefer or {}), list(extracts)
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [df.withColumn("_system", F.lit(name)) for name, df in extracts.items()])
    fields = [c for c in both.columns if c not in (key, changed, "_system")]

    def rank(order: Sequence[str]) -> Column:
        return reduce(lambda rest, pair: F.when(F.col("_system") == pair[1], F.lit(-pair[0])).otherwise(rest), enumerate(order), F.lit(-len(order)))

    def winner(field: str) -> Column:
        newest = [F.col(changed).isNotNull(), F.col(changed)]
        place = [rank(prefer[field]), *newest] if field in prefer else [*newest]
        order = F.struct(*[p.alias(f"p{n}") for n, p in enumerate([*place, rank(known), F.col(field)])])
        return F.max_by(F.struct(F.col(field).alias("value"), F.col("_system").alias("system")), F.when(F.col(field).isNotNull(), order)).alias(field)

    kept = both.where(F.col(key).isNotNull()).groupBy(key).agg(*[winner(f) for f in fields], F.array_join(F.sort_array(F.collect_set("_system")), ",").alias("systems"))
    told = [c for f in fields for c in (F.col(f"{f}.value").alias(f), F.col(f"{f}.system").alias(f"{f}_from"))]
    return kept.select(key, *told, "systems")
