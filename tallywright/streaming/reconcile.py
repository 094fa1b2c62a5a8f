"""Orders against invoices as they arrive."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywright.functions import money
from tallywright.operators import joins, recon
from tallywright.sources.merge_table import MergeTable

LATENESS = "1 day"
MATCH_WINDOW = "7 days"


def reconcile(
    orders: DataFrame,
    invoices: DataFrame,
    lateness: str = LATENESS,
    window: str = MATCH_WINDOW,
    preset: str = "strict",
    tolerance: Decimal = money.AMOUNT_TOLERANCE,
    tolerance_days: int = recon.DATE_TOLERANCE_DAYS,
) -> DataFrame:
    """Full outer stream join, classified like the batch comparison.

    A pair comes out at once; an order or invoice that stays alone comes out once
    the watermark has left ``window`` behind, which also bounds the state.  Rows
    without a key can never match and must be split off before.
    """
    ops = (
        recon.full_ops(orders, preset)
        .withColumn("order_ts", F.col("order_date").cast("timestamp"))
        .withWatermark("order_ts", lateness)
        .alias("o")
    )
    fin = (
        recon.full_fin(invoices)
        .withColumn("invoice_ts", F.col("invoice_date").cast("timestamp"))
        .withWatermark("invoice_ts", lateness)
        .alias("i")
    )
    near = F.expr(
        "o.order_id = i.order_id "
        f"AND i.invoice_ts >= o.order_ts - INTERVAL {window} "
        f"AND i.invoice_ts <= o.order_ts + INTERVAL {window}"
    )
    joined = ops.join(fin, near, "full_outer").select(
        F.coalesce("o.order_id", "i.order_id").alias("order_id"),
        "o.order_date",
        "i.invoice_date",
        "o.customer_name",
        "o.sales",
        "i.invoice_amount",
        "o.active",
        "i.live",
        "o._ops",
        "i._fin",
    )
    return recon.classify(joined, tolerance, tolerance_days)


def late_rows(source: DataFrame, seen: DataFrame, key: str = "order_id") -> DataFrame:
    """Batch catch-up: source rows the stream's result does not hold, because they came
    after the watermark or are still waiting for their partner."""
    return joins.anti_join(source, seen, key)


def known_so_far(orders: DataFrame, invoices: DataFrame, preset: str = "strict") -> DataFrame:
    """Streams of orders and invoices as one: a row for each order id that a micro-batch touches, with all
    that has come for it so far (for output mode "update").

    The state is one narrow row per order id, in the state store; it is never given up, since an orphan's
    partner may come at any later time.  A row that comes again changes nothing; of several different
    ones for an id the greatest counts, in whatever order they come.  Rows without a key are left out.
    """
    ops = recon.full_ops(orders, preset).select("order_id", F.struct("order_date", "customer_name", "sales", "active").alias("ops"))
    fin = recon.full_fin(invoices).select("order_id", F.struct("invoice_date", "invoice_amount", "live").alias("fin"))
    both = ops.unionByName(fin, allowMissingColumns=True).where(F.col("order_id").isNotNull())
    return both.groupBy("order_id").agg(F.max("ops").alias("ops"), F.max("fin").alias("fin"))


def classified(
    known: DataFrame, tolerance: Decimal = money.AMOUNT_TOLERANCE, tolerance_days: int = recon.DATE_TOLERANCE_DAYS
) -> DataFrame:
    """:func:`known_so_far` judged like the batch comparison."""
    rows = known.select("order_id", "ops.*", "fin.*", F.col("ops").isNotNull().alias("_ops"), F.col("fin").isNotNull().alias("_fin"))
    return recon.classify(rows, tolerance, tolerance_days)


def correct(
    orders: DataFrame,
    invoices: DataFrame,
    table: MergeTable,
    checkpoint: str,
    corrections: str | None = None,
    preset: str = "strict",
    tolerance: Decimal = money.AMOUNT_TOLERANCE,
    tolerance_days: int = recon.DATE_TOLERANCE_DAYS,
) -> StreamingQuery:
    """Keep ``table`` equal to the full comparison of all orders and invoices that have come.

    An order or invoice without a partner is an orphan at once, and withdrawn when its partner comes, however
    late.  ``corrections`` is a folder for the history: what was withdrawn (op ``-``) and what took its
    place (op ``+``), by micro-batch in ``batch``.  Both can be repeated: a batch is replaced, not added.
    """

    def apply(batch: DataFrame, number: int) -> None:
        found = classified(batch, tolerance, tolerance_days)
        now = F.struct(*found.columns)
        if table.exists():
            before = table.read().select("order_id", F.struct(*found.columns).alias("was"))
            met = found.select("order_id", now.alias("now")).join(before, "order_id", "left")
            met = met.where(~F.col("now").eqNullSafe(F.col("was"))).select("now", "was").persist()
        else:
            met = found.select(now.alias("now"), F.lit(None).cast(found.select(now.alias("x")).schema["x"].dataType).alias("was")).persist()
        if corrections:
            told = [F.when(F.col(side).isNotNull(), F.struct(F.lit(op).alias("op"), F.col(side).alias("row"))) for op, side in (("-", "was"), ("+", "now"))]
            lines = met.select(F.explode(F.array_compact(F.array(*told))).alias("line")).select("line.row.*", "line.op")
            lines.write.mode("overwrite").parquet(f"{corrections}/batch={number}")
        table.upsert(met.select("now.*", F.lit(number).alias("_batch")), "_batch", batch=(checkpoint, number))
        table.compact()
        met.unpersist()

    query = known_so_far(orders, invoices, preset).writeStream.outputMode("update").foreachBatch(apply)
    return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
