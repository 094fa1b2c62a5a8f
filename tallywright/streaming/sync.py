"""Incremental loads and change feeds."""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tallywright.functions.hashing import content_id
from tallywright.operators import erp, filters, windows
from tallywright.sources import sinks
from tallywright.sources.append_log import AppendLog
from tallywright.sources.manifest import Manifest
from tallywright.sources.merge_table import MergeTable
from tallywright.streaming import runner

FULL_LOAD_DAYS = 30
FIRST_LOAD_DAYS = 1
#: How far before the mark a load reads again: a row may be seen by readers that long after its change time.
OVERLAP = dt.timedelta(hours=1)


def incremental(
    spark: SparkSession,
    path: str,
    fields: list[str],
    system: str,
    table: str,
    target: str,
    checkpoint: str,
    fmt: str = "csv",
    first_since: dt.date | None = None,
) -> DataFrame:
    """Load the extract files that landed since the last run.

    The checkpoint remembers which files are done, so it replaces a stored sync
    time.  ``first_since`` cuts the very first load (one day back by convention).
    """
    schema = StructType([StructField(f, StringType()) for f in fields])
    options = {"header": "true"} if fmt == "csv" else {}
    landed = runner.read_files(spark, path, schema, fmt, **options)
    mapped = erp.from_erp(landed, system, table)
    if first_since is not None:
        day = "order_date" if table == "sales_orders" else "invoice_date"
        mapped = mapped.where(F.col(day) >= F.lit(first_since.isoformat()).cast("date"))
    return runner.run_to_files(mapped, target, checkpoint)


class Load(NamedTuple):
    """What one incremental load read (from ``since`` up to ``until``), added, and how far it came."""

    since: str
    until: str
    rows_read: int
    rows_new: int
    mark: str | None


class Marks:
    """How far each table of each system has been read, kept in a folder.

    A mark is a text in the session's time zone.  It is moved by compare-and-set: of two loads that started
    from the same mark, the second to end fails with :class:`Conflict`.  Every move is a version of its own,
    so the versions are the history of the loads.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder.rstrip("/")

    def _manifest(self, system: str, table: str) -> Manifest:
        return Manifest(self._spark, f"{self._folder}/{system}/{table}")

    def read(self, system: str, table: str) -> tuple[int, str | None]:
        """(version, mark) of a table; (0, None) before its first load."""
        version, content = self._manifest(system, table).read()
        return version, content.get("mark")

    def move(self, system: str, table: str, after: int, load: Load) -> None:
        """Keep the mark of a load that started from version ``after``."""
        self._manifest(system, table).commit(after, load._asdict())

    def loads(self, system: str, table: str) -> list[Load]:
        """The loads of a table that came to their end, oldest first."""
        manifest = self._manifest(system, table)
        return [Load(**content) for content in (manifest.read(n)[1] for n in manifest.numbers()) if content]


def load_new(
    source: DataFrame,
    changed: str,
    log: AppendLog,
    marks: Marks,
    system: str,
    table: str,
    as_of: dt.datetime,
    overlap: dt.timedelta = OVERLAP,
    first: dt.timedelta = dt.timedelta(days=FIRST_LOAD_DAYS),
) -> Load:
    """Add the rows of a source table that changed since the last load to a log.

    Rows from ``overlap`` before the mark up to ``as_of`` are read, in the first load those of the ``first``
    days before ``as_of``; the bounds reach the source's scan.  ``log.key`` is a new column, the id of a row's whole
    content, so rows that are read again, and whole loads that failed before the mark moved, add nothing.
    The mark moves after the log has committed, to the newest change time seen, never back.  Identical rows
    count once; rows without a change time belong to no load.  :func:`current_state` gives the newest state of a key.
    """
    version, mark = marks.read(system, table)
    since = dt.datetime.fromisoformat(mark) - overlap if mark else as_of - first
    at = source.schema[changed].dataType
    rows = source.where((F.col(changed) >= F.lit(str(since)).cast(at)) & (F.col(changed) < F.lit(str(as_of)).cast(at)))
    # Before the load: a row that turns up between the two reads is loaded and read again, not passed over.
    n, newest = rows.agg(F.count("*"), F.max(changed).cast("string")).first()
    new = log.append(rows.withColumn(log.key, content_id(*sorted(source.columns)))) if n else 0
    reached = max((dt.datetime.fromisoformat(t) for t in (mark, newest) if t), default=None)
    load = Load(str(since), str(as_of), n, new, None if reached is None else str(reached))
    marks.move(system, table, version, load)
    return load


def full_load(df: DataFrame, column: str, as_of: dt.date, days: int = FULL_LOAD_DAYS) -> DataFrame:
    """Batch counterpart: the last ``days`` days up to ``as_of``."""
    return filters.date_range(df, as_of - dt.timedelta(days=days), as_of, column)


def append_changes(changes: DataFrame, path: str, checkpoint: str, partitions: int | None = None) -> DataFrame:
    """Append a change feed to its history; the cost follows the changes, not the table."""
    return runner.run_to_files(changes, path, checkpoint, partitions)


def current_state(
    history: DataFrame, key: str | list[str], order: str, op: str | None = None, delete: str = "D"
) -> DataFrame:
    """Latest row per key of a change history, without keys deleted last.

    Combines per task before the shuffle: a key with very many changes sends one
    row per task.
    """
    last = windows.keep_last(history, key, order)
    return last if op is None else last.where(F.coalesce(F.col(op) != delete, F.lit(True)))


def upsert_stream(
    changes: DataFrame,
    table: MergeTable | str,
    key: str,
    seq: str,
    checkpoint: str,
    partition_by: str | None = None,
    op: str | None = None,
    delete: str = "D",
) -> StreamingQuery:
    """Apply each micro-batch to a table, deletes (rows whose ``op`` says so) included; replaying a batch
    or getting an older one changes nothing.

    A :class:`MergeTable` takes the changes as they are and is compacted where they pile up.  A
    catalog table (its name; read it with :func:`sinks.live`) has its touched partitions rewritten.
    """

    def apply(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        gone = None if op is None else F.col(op) == delete
        if isinstance(table, MergeTable):
            table.upsert(batch, seq, gone, (checkpoint, number))
            table.compact()
        else:
            sinks.upsert(batch, table, key, seq, partition_by, gone)

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
