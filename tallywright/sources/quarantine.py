"""The reject channel: one pass over a source writes what converts, what does not and what lies outside the
wanted range, and proves that rows in equal rows out.

Counters travel with the write itself (``Observation``): one where the source is read, one where rows are
written.  A stage that runs again after the loss of an executor may count twice, so a difference is
checked once more by counting source and result, and only then is an error.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, functions as F

from tallywright.operators import erp, ingest
from tallywright.session import work_dir
from tallywright.sources import readers

OUTCOME = "outcome"
ACCEPTED, REJECTED, OUT_OF_RANGE = "accepted", "rejected", "out_of_range"

Judge = Callable[[DataFrame], DataFrame]


class LostRows(RuntimeError):
    """A source and what became of it differ in the number of rows."""


@dataclass(frozen=True)
class Counts:
    rows_in: int
    accepted: int
    rejected: int
    out_of_range: int

    @property
    def whole(self) -> bool:
        return self.rows_in == self.accepted + self.rejected + self.out_of_range


@dataclass(frozen=True)
class Split:
    """The written rows, each in one of three parts; ``counts`` add up."""

    rows: DataFrame
    counts: Counts

    def part(self, outcome: str) -> DataFrame:
        return self.rows.where(F.col(OUTCOME) == outcome).drop(OUTCOME)

    @property
    def accepted(self) -> DataFrame:
        return self.part(ACCEPTED).drop("reject_reason", "told")

    @property
    def rejected(self) -> DataFrame:
        return self.part(REJECTED)


def raw_lines(lenient: Iterable[str] = ()) -> Judge:
    """Raw order lines of any spelling; see :func:`ingest.judged_lines`."""
    return lambda raw: ingest.judged_lines(ingest.harmonise(raw), lenient)


def erp_rows(
    system: str,
    table: str,
    start: str | dt.date,
    end: str | dt.date,
    extra: erp.Extra | None = None,
    amounts_in_cents: bool = False,
) -> Judge:
    """Rows of an ERP extract; those that convert but lie outside the dates are kept apart."""

    def judge(extract: DataFrame) -> DataFrame:
        rows = erp.judged(extract, system, table, extra, amounts_in_cents)
        inside = F.coalesce(readers.erp_range(table, system, rows.columns, start, end), F.lit(False))
        fits = F.when(inside, ACCEPTED).otherwise(OUT_OF_RANGE)
        return rows.withColumn(OUTCOME, F.when(F.col("reject_reason").isNotNull(), REJECTED).otherwise(fits))

    return judge


def export_rows(raw: DataFrame) -> DataFrame:
    """Rows of a transaction export; amounts and dates must read."""
    told = raw.withColumn("told", F.struct("amount", "date"))
    typed = readers.typed_export(told)
    reasons = [F.when(F.col(f"{c}_unreadable"), F.lit(f"{c} unreadable")) for c in ("amount", "date")]
    reason = F.nullif(F.concat_ws("; ", *reasons), F.lit(""))
    told_if_lost = F.when(reason.isNotNull(), F.col("told"))
    return typed.withColumns({"reject_reason": reason, "told": told_if_lost}).drop("amount_unreadable", "date_unreadable")


def split(source: DataFrame, judge: Judge, path: str | None = None) -> Split:
    """Write ``judge(source)`` below ``path`` (a new folder of the shared one by default), parted by outcome.

    ``judge`` keeps every row and adds ``reject_reason``; it may add ``outcome`` itself.  Raises
    :class:`LostRows` if rows are missing or too many.
    """
    spark = source.sparkSession
    path = path or f"{work_dir(spark)}/split-{uuid.uuid4().hex}"
    read, written = Observation(), Observation()
    judged = judge(source.observe(read, F.count(F.lit(1)).alias("rows")))
    if OUTCOME not in judged.columns:
        judged = judged.withColumn(OUTCOME, F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED))
    tallies = [F.count_if(F.col(OUTCOME) == name).alias(name) for name in (ACCEPTED, REJECTED, OUT_OF_RANGE)]
    judged.observe(written, *tallies).write.partitionBy(OUTCOME).parquet(path)
    rows = spark.read.schema(judged.schema).parquet(path)
    counts = Counts(read.get["rows"], **written.get)
    if not counts.whole:
        counts = Counts(source.count(), *rows.agg(*tallies).first())
        if not counts.whole:
            raise LostRows(f"{path}: {counts}")
    return Split(rows, counts)


def reasons(parted: Split) -> DataFrame:
    """Rejected rows by reason."""
    return parted.rejected.groupBy("reject_reason").agg(F.count("*").alias("n_rows"))
