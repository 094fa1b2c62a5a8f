"""The full comparison of orders and invoices, kept up to date from what has changed."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import DecimalType

from tallywright.functions import money
from tallywright.operators import recon
from tallywright.sources.merge_table import BUCKETS, MergeTable

FEED = "changes"
_ORDER = ("order_id", "order_date", "customer_name", "sales", "order_status")
_INVOICE = ("order_id", "invoice_date", "invoice_amount", "payment_status")
_FIGURES = {"summary": recon.summary_counts, "audit": recon.audit_counts, "report": recon.report_counts}


class Comparison:
    """Orders, invoices and their full outer comparison (:func:`recon.full`) as merge-on-read tables.

    A change set costs what it touches: its keys alone are compared anew, in the buckets that hold them, and
    the figures of the run's reports move by the difference between the old and the new rows of these keys.
    Rows and figures become visible in one step.  There is one writer at a time, a second one fails.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        buckets: int = BUCKETS,
        preset: str = "strict",
        tolerance: Decimal = money.AMOUNT_TOLERANCE,
        tolerance_days: int = recon.DATE_TOLERANCE_DAYS,
    ):
        self.spark, self._preset, self._tolerances = spark, preset, (tolerance, tolerance_days)
        self.orders, self.invoices, self.rows = (MergeTable(spark, f"{folder}/{name}", "order_id", buckets) for name in ("orders", "invoices", "rows"))

    def apply(self, orders: DataFrame, invoices: DataFrame, number: int, seq: str = "seq", gone: Column | None = None) -> bool:
        """Take change set ``number`` (0, 1, 2 and so on); False if it is there already.

        Both frames hold the changed rows whole and their sequence ``seq``; ``gone`` is true for deletes.  The
        change with the greatest sequence of a key wins, whenever it comes.  Rows without a key are left out.
        After a failure the same change set has to come again before the next one does; whatever step it broke
        off at, nothing is lost or counted twice.
        """
        done = self.rows.applied(FEED)
        if number <= done:
            return False
        if number != done + 1:
            raise ValueError(f"change set {done + 1} comes before {number}")
        version = self.rows.manifest.read()[0]
        mark = F.coalesce(gone, F.lit(False)) if gone is not None else F.lit(False)
        for table, changes, fields in ((self.orders, orders, _ORDER), (self.invoices, invoices, _INVOICE)):
            told = changes.select(*fields, F.col(seq).alias("_change"), mark.alias("_gone"))
            table.upsert(told, "_change", F.col("_gone"), (FEED, number))
        keys = orders.select("order_id").unionByName(invoices.select("order_id")).where(F.col("order_id").isNotNull()).distinct().persist()
        changed = self._changed(keys).persist()
        try:
            now = changed.select("order_id", *[F.col(f"now.{c}").alias(c) for c in self._columns(changed)])
            vanished = F.col("status").isNull()  # every compared row has one
            self.rows.upsert(now.withColumn("_number", F.lit(number)), "_number", vanished, (FEED, number), self._figures_after(changed), version)
        finally:
            changed.unpersist()
            keys.unpersist()
        return True

    def _columns(self, changed: DataFrame) -> list[str]:
        return [c for c in changed.schema["now"].dataType.fieldNames() if c != "order_id"]

    def _changed(self, keys: DataFrame) -> DataFrame:
        """Keys whose compared row is another one now: the row (``now``) and the one before (``was``)."""
        ops = recon.full_ops(self.orders.read_keys(keys), self._preset)
        fin = recon.full_fin(self.invoices.read_keys(keys))
        now = recon.classify(ops.join(fin, "order_id", "full_outer"), *self._tolerances)
        whole = F.struct(*now.columns)
        was = self.rows.read_keys(keys) if self.rows.exists() else now.where(F.lit(False))
        met = now.select("order_id", whole.alias("now")).join(was.select("order_id", whole.alias("was")), "order_id", "full_outer")
        return met.where(~F.col("now").eqNullSafe(F.col("was")))

    def _figures_after(self, changed: DataFrame) -> dict[str, dict[str, str]]:
        """The figures with the rows before taken off and those of now added."""
        sides = [F.when(F.col(side).isNotNull(), F.struct(F.lit(sign).alias("sign"), F.col(side).alias("row"))) for side, sign in (("was", -1), ("now", 1))]
        rows = changed.select(F.explode(F.array_compact(F.array(*sides))).alias("side")).select("side.sign", "side.row.*")
        sums: list[Row] = rows.groupBy("sign").agg(*[F.struct(*counts()).alias(name) for name, counts in _FIGURES.items()]).collect()  # two at most
        figures = {name: {c: Decimal(value) for c, value in self.rows.notes().get(name, {}).items()} for name in _FIGURES}
        for row in sums:
            for name in _FIGURES:
                for c, value in row[name].asDict().items():
                    figures[name][c] = figures[name].get(c, Decimal(0)) + row.sign * value
        return {name: {c: str(value) for c, value in kept.items()} for name, kept in figures.items()}

    def _line(self, name: str) -> DataFrame:
        """The figures of a report as one row; no row of the comparison is read."""
        schema = self.rows.read().agg(*_FIGURES[name]()).schema
        told = self.rows.notes()[name]  # without figures, nothing has ever been compared
        values = [(Decimal if isinstance(f.dataType, DecimalType) else int)(told.get(f.name, "0")) for f in schema.fields]
        return self.spark.createDataFrame([tuple(values)], schema)

    def read(self) -> DataFrame:
        """The comparison as it stands."""
        return self.rows.read()

    def summary(self) -> DataFrame:
        """:func:`recon.summary` from the kept figures."""
        return self._line("summary")

    def audit_row(self, as_of: str, period: str = "all", executed_by: str = "scheduler", notes: str | None = None) -> DataFrame:
        """:func:`recon.audit_row` from the kept figures."""
        return recon.audit_line(self._line("audit"), as_of, period, executed_by, notes)

    def control_report(self) -> DataFrame:
        """:func:`recon.control_report` from the kept figures."""
        return recon.report_line(self._line("report"))

    def compact(self) -> None:
        """Compact the buckets of the three tables that are due."""
        for table in (self.orders, self.invoices, self.rows):
            table.compact()
