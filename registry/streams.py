"""Streaming jobs, run to the end of the given data."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from registry.base import Registry, sql_with
from registry.changes import LIVE, order_changes
from tallywright.session import settings, work_dir
from tallywright.sources import bindings
from tallywright.sources.append_log import AppendLog
from tallywright.sources.merge_table import MergeTable
from tallywright.streaming import monitors, panes, reconcile, runner, sync

REGISTRY = Registry()


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = bindings.table(spark, folder, name).schema
    # A pattern, as the table may be one file and a plain path must be a folder.
    return runner.read_files(spark, f"{folder}/{name}.parque[t]", schema)


def _finish(stream: DataFrame, name: str) -> DataFrame:
    """Run into a new table of the shared folder; as many state partitions as cores."""
    spark = stream.sparkSession
    base = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    partitions = spark.sparkContext.defaultParallelism
    return runner.run_to_files(stream, f"{base}/table", f"{base}/checkpoint", partitions)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return _stream(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    """The same events as a batch, for windows the stream leaves open."""
    return bindings.table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@REGISTRY.query("SELECT event_id, user_id, event_type FROM events")
def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """A feed that delivers every tenth event twice."""
    copies = F.when(F.col("event_id") % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    replayed = _events(spark, folder).withColumn("copy", F.explode(copies))
    return _finish(monitors.dedupe(replayed, "event_id", "ts").select("event_id", "user_id", "event_type"), "dedupe")


@REGISTRY.query(
    """
    WITH e AS (SELECT * FROM events WHERE event_type = 'error')
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, COUNT(*) AS failures FROM e
    GROUP BY date_trunc('hour', ts)
    HAVING COUNT(*) > 3"""
)
def stream_auth_failures(spark: SparkSession, folder: str) -> DataFrame:
    failed = lambda events: events.where(F.col("event_type") == "error")
    count = lambda events: monitors.auth_failures(events, "ts")
    closed = _finish(count(failed(_events(spark, folder))), "auth")
    return monitors.completed(closed, failed(_landed(spark, folder)), "ts", count, F.col("hour"), "1 hour")


def _work(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _landings(frame: DataFrame, part: Column, folder: str, runs: int = 3) -> Iterator[DataFrame]:
    """The frame as a stream that grows: part after part lands in a folder, and each time the stream
    over the folder is handed out to be run up to there."""
    for k in range(runs):
        frame.where(part == k).write.mode("append").parquet(folder)
        yield runner.read_files(frame.sparkSession, folder, frame.schema)


def _panes(spark: SparkSession, folder: str) -> panes.PaneStore:
    """Panes of all events, a third of which lands at a time."""
    base = _work(spark, "panes")
    store = panes.PaneStore(spark, f"{base}/store")
    for stream in _landings(_landed(spark, folder), F.col("event_id") % 3, f"{base}/landing"):
        with settings(spark, runner.stream_settings(spark.sparkContext.defaultParallelism)):
            query = panes.run(store, stream, "ts", "user_id", "event_type", f"{base}/checkpoint")
        query.awaitTermination()
    return store


@REGISTRY.query(
    """
    WITH w AS (SELECT date_trunc('hour', ts) - INTERVAL 1 HOUR * i AS window_start, user_id, event_type
               FROM events, range(24) r(i))
    SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, CAST(user_id AS VARCHAR) AS auditor_id, COUNT(*) AS access_count,
           CAST(COUNT(DISTINCT event_type) AS INTEGER) AS entity_types
    FROM w GROUP BY w.window_start, user_id
    HAVING COUNT(*) > 8"""
)
def stream_access(spark: SparkSession, folder: str) -> DataFrame:
    """Day-long windows as sums of hourly panes, over several micro-batches with late rows."""
    return panes.busy_days(_panes(spark, folder).stored(), limit=8)


@REGISTRY.query(
    """
    WITH marks AS (
        SELECT e.*, (SELECT max(ts) FROM events AS b WHERE b.event_id % 3 < e.event_id % 3) - INTERVAL 1 DAY AS mark FROM events AS e)
    SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, CAST(COUNT(*) AS BIGINT) AS n,
        CAST(COUNT(*) FILTER (date_trunc('hour', ts) + INTERVAL 1 HOUR <= mark) AS BIGINT) AS n_late
    FROM marks GROUP BY date_trunc('hour', ts)
    HAVING n_late > 0"""
)
def stream_late(spark: SparkSession, folder: str) -> DataFrame:
    """Closed hours that rows behind the watermark have corrected."""
    return panes.late_counts(_panes(spark, folder).stored())


@REGISTRY.query(
    """
    SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, user_id AS customer, COUNT(*) AS orders, 'LOW' AS severity FROM events
    GROUP BY CAST(ts AS DATE), user_id
    HAVING COUNT(*) > 5"""
)
def stream_frequency(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of several lines, every tenth delivered twice: each counts once."""
    # Day windows follow UTC: read the zone-free time as UTC whatever the session's zone.
    as_utc = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col("ts")).cast("timestamp")
    lines = F.explode(F.sequence(F.lit(1), F.when(F.col("event_id") % 10 == 0, 4).otherwise(1 + F.col("event_id") % 3).cast("int")))
    count = lambda orders: monitors.order_frequency(orders, "ts", "user_id", limit=5, order="event_id")
    shape = lambda events: events.withColumn("ts", as_utc).withColumn("line", lines)
    closed = _finish(count(shape(_stream(spark, folder, "events"))), "frequency")
    landed = shape(bindings.table(spark, folder, "events"))
    return monitors.completed(closed, landed, "ts", count, F.timestamp_seconds(F.unix_date("day") * 86_400), "1 day")


@REGISTRY.query(
    """
    SELECT user_id, event_id, event_type, value FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events)
    WHERE n = 1 AND event_type <> 'error'"""
)
def stream_cdc(spark: SparkSession, folder: str) -> DataFrame:
    """Latest state per user of a change feed in which an error event deletes the user."""
    changes = _events(spark, folder).select("user_id", "event_id", "event_type", "value")
    history = _finish(changes, "cdc")
    return sync.current_state(history, "user_id", "event_id", op="event_type", delete="error")


def _reconciled(spark: SparkSession, folder: str) -> tuple[MergeTable, str]:
    """Orders and invoices that land in three parts each, cut differently: most partners come apart."""
    base = _work(spark, "reconcile")
    table, checkpoint, corrections = MergeTable(spark, f"{base}/table", "order_id", buckets=16), f"{base}/checkpoint", f"{base}/corrections"
    source = bindings.table(spark, folder, "orders")
    key = F.col("o_orderkey")
    both = zip(_landings(source, key % 3, f"{base}/orders"), _landings(source, F.floor(key / 3) % 3, f"{base}/invoices"))
    for orders, invoices in both:
        ops = bindings.order_columns(orders).withColumn("customer_name", F.lit(None).cast("string"))
        with settings(spark, runner.stream_settings(spark.sparkContext.defaultParallelism)):
            query = reconcile.correct(ops, bindings.invoice_columns(invoices), table, checkpoint, corrections)
        query.awaitTermination()
    return table, corrections


@REGISTRY.query(
    sql_with("compared", body="""
        SELECT order_id, CAST(order_date AS VARCHAR) AS order_date, CAST(invoice_date AS VARCHAR) AS invoice_date, CAST(sales AS DOUBLE) AS sales,
               CAST(invoice_amount AS DOUBLE) AS invoice_amount, in_ops, in_fin, active, live, CAST(amount_diff AS DOUBLE) AS amount_diff, days_apart, status
        FROM compared""")
)
def stream_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """The comparison as the stream leaves it after its last micro-batch; nothing is added in batch."""
    return _reconciled(spark, folder)[0].read().drop("customer_name")


@REGISTRY.query(
    sql_with("compared", body="""
        , parts AS (
            SELECT *, CASE WHEN in_ops THEN k % 3 END AS o, CASE WHEN in_fin THEN (b // 3) % 3 END AS i
            FROM (SELECT *, CAST(order_id AS BIGINT) AS k, CASE WHEN in_ops THEN CAST(order_id AS BIGINT) ELSE CAST(order_id AS BIGINT) - 100000000 END AS b FROM compared)),
        early AS (SELECT order_id, least(o, i) AS batch, CASE WHEN i < o THEN 'FIN_ONLY' WHEN active THEN 'OPS_ONLY' ELSE 'EXCLUDED' END AS status FROM parts WHERE o <> i)
        SELECT order_id, CAST(coalesce(greatest(o, i), o, i) AS INTEGER) AS batch, '+' AS op, status FROM parts
        UNION ALL SELECT order_id, CAST(batch AS INTEGER), '+', status FROM early
        UNION ALL SELECT early.order_id, CAST(greatest(o, i) AS INTEGER), '-', early.status FROM early JOIN parts ON parts.order_id = early.order_id""")
)
def stream_corrections(spark: SparkSession, folder: str) -> DataFrame:
    """Orphans that the stream has told of and withdrawn, and what took their place."""
    _, corrections = _reconciled(spark, folder)
    return spark.read.parquet(corrections).select("order_id", "batch", "op", "status")


@REGISTRY.query(sql_with("so", body=LIVE))
def stream_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Orders after changes that come out of order from a stream, deletes among them."""
    base = _work(spark, "upserts")
    table = MergeTable(spark, f"{base}/table", "order_id", buckets=16)
    for change in order_changes(spark, folder):
        change.write.mode("append").parquet(f"{base}/landing")
        stream = runner.read_files(spark, f"{base}/landing", change.schema)
        sync.upsert_stream(stream, table, "order_id", "seq", f"{base}/checkpoint", op="op").awaitTermination()
    return table.read().drop("year", "op")


@REGISTRY.query(
    """
    WITH bounds AS (SELECT min(ts) + to_seconds(CAST(floor(epoch(max(ts) - min(ts)) / 3) AS BIGINT)) - INTERVAL 1 DAY AS since FROM events)
    SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, user_id, event_type, value FROM events, bounds WHERE ts >= since"""
)
def sync_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Events loaded in three runs, the first one day back: every tenth is seen by readers only after the run
    in whose last hours it falls, and the second run breaks off once, before its mark moves."""
    base, events = _work(spark, "sync"), _landed(spark, folder)
    first, last = (dt.datetime.fromisoformat(str(t)) for t in events.agg(F.min("ts").cast("string"), F.max("ts").cast("string")).first())
    third, overlap = dt.timedelta(seconds=int((last - first).total_seconds() // 3)), dt.timedelta(hours=6)
    ends = [first + third, first + 2 * third, last + dt.timedelta(seconds=1)]
    log = AppendLog(spark, f"{base}/log", "content", F.date_format("ts", "yyyy-MM-dd"), prefixes=4)
    marks, broken = sync.Marks(spark, f"{base}/marks"), sync.Marks(spark, f"{base}/broken")
    for run, end in enumerate(ends):
        unseen = (F.col("event_id") % 10 == 0) & (F.col("ts") >= F.lit(str(end - overlap / 2)).cast("timestamp"))
        seen = events if run == 2 else events.where(~unseen)
        if run == 1:  # its rows are in the log, the mark is where it was
            sync.load_new(seen, "ts", log, broken, "shop", "events", end, overlap, third + overlap)
        sync.load_new(seen, "ts", log, marks, "shop", "events", end, overlap)
    return log.read().select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "user_id", "event_type", "value")
