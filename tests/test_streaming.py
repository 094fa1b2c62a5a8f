from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.operators import recon
from tallywright.schemas import AUDIT_LOGS
from tallywright.sources import sinks
from tallywright.sources.merge_table import MergeTable
from tallywright.streaming import audit, monitors, panes, reconcile, runner, sync

D = dt.date
ORDERS = "order_id string, order_date date, sales decimal(18,2), customer_name string, order_status string"
INVOICES = "order_id string, invoice_date date, invoice_amount decimal(18,2), payment_status string"


@pytest.fixture
def land(spark, tmp_path):
    """Write a frame into a landing folder and read the folder as a stream."""

    def write(name, data, schema):
        df = spark.createDataFrame(data, schema)
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
        return runner.read_files(spark, str(tmp_path / name), df.schema)

    return write


def finish(stream, tmp_path, name="t"):
    return runner.run_to_files(stream, str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-check"), 2, timeout=120)


def test_reconcile_equals_batch_after_the_watermark(spark, land, tmp_path, rows):
    ten = Decimal("10.00")
    orders = [("a", D(2024, 1, 1), ten, "n", "COMPLETE"), ("b", D(2024, 1, 1), ten, "n", "COMPLETE"),
              ("c", D(2024, 1, 2), ten, "n", "CANCELED"), ("d", D(2024, 1, 2), ten, "n", "COMPLETE")]
    invoices = [("a", D(2024, 1, 3), ten, "Paid"), ("c", D(2024, 1, 2), ten, "Paid"),
                ("d", D(2024, 1, 2), Decimal("11.00"), "Paid"), ("g", D(2024, 1, 2), ten, "Paid")]
    marker_o = [("zz-o", D(2024, 3, 1), ten, "n", "COMPLETE")]
    marker_i = [("zz-i", D(2024, 3, 1), ten, "Paid")]
    land("o", orders, ORDERS), land("i", invoices, INVOICES)
    stream = reconcile.reconcile(land("o", marker_o, ORDERS), land("i", marker_i, INVOICES))
    found = finish(stream, tmp_path).where(~F.col("order_id").startswith("zz"))
    batch = recon.full(spark.createDataFrame(orders, ORDERS), spark.createDataFrame(invoices, INVOICES))
    columns = ["order_id", "status", "in_ops", "in_fin", "active", "live", "amount_diff", "days_apart"]
    assert rows(found, *columns) == rows(batch, *columns)


def test_late_order_is_caught_by_the_batch(spark, land, tmp_path, rows):
    ten = Decimal("10.00")
    land("o", [("new", D(2024, 3, 1), ten, "n", "COMPLETE")], ORDERS)
    ops = land("o", [], ORDERS)
    fin = land("i", [("new", D(2024, 3, 1), ten, "Paid")], INVOICES)
    finish(reconcile.reconcile(ops, fin), tmp_path)
    late = [("late", D(2024, 1, 1), ten, "n", "COMPLETE")]
    seen = finish(reconcile.reconcile(land("o", late, ORDERS), fin), tmp_path)
    assert rows(seen, "order_id") == [("new",)]
    source = spark.read.parquet(str(tmp_path / "o"))
    assert rows(reconcile.late_rows(source, seen), "order_id") == [("late",)]


EVENTS = "event_id int, user string, kind string, ts timestamp"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_monitors(spark, land, tmp_path, rows):
    data = [(i, "u", "login" if i % 2 else "read", at(1, 5)) for i in range(5)]
    data += [(100, "v", "read", at(1, 6)), (999, "end", "x", at(20))]
    stream = land("e", data, EVENTS)
    found = finish(monitors.auth_failures(stream, "ts"), tmp_path, "auth")
    assert rows(found) == [(at(1, 5), 5)]
    found = finish(monitors.order_frequency(stream, "ts", "user", limit=4), tmp_path, "freq")
    assert rows(found) == [(D(2024, 1, 1), "u", 5, "LOW")]
    found = finish(monitors.access_counts(stream, "ts", "user", "kind", limit=4), tmp_path, "acc")
    assert found.count() == 24
    assert rows(found.select("auditor_id", "access_count", "entity_types").distinct()) == [("u", 5, 2)]


def test_replayed_file_does_not_count_twice(spark, land, tmp_path):
    data = [(i, "u", "read", at(1, i)) for i in range(6)]
    land("e", data, EVENTS)
    stream = land("e", data, EVENTS)
    once = finish(monitors.dedupe(stream, "event_id", "ts"), tmp_path)
    assert once.count() == 6
    land("e", data, EVENTS)
    assert finish(monitors.dedupe(stream, "event_id", "ts"), tmp_path).count() == 6


def test_changes(spark, land, tmp_path, rows):
    schema = "k string, seq int, op string, v int"
    stream = land("c", [("a", 1, "I", 1), ("a", 3, "U", 3), ("b", 1, "I", 1)], schema)
    sync.append_changes(stream, str(tmp_path / "hist"), str(tmp_path / "hist-check"))
    land("c", [("a", 2, "U", 2), ("b", 2, "D", None)], schema)
    history = sync.append_changes(stream, str(tmp_path / "hist"), str(tmp_path / "hist-check"))
    assert rows(sync.current_state(history, "k", "seq", "op"), "k", "v") == [("a", 3)]
    assert history.count() == 5


def test_upsert_stream(stores, land, tmp_path, rows):
    stream = land("c", [("a", 1, 10), ("a", 2, 20), ("b", 1, 1)], "k string, seq int, v int")
    sync.upsert_stream(stream, "operations.live", "k", "seq", str(tmp_path / "chk")).awaitTermination(120)
    land("c", [("b", 5, 50)], "k string, seq int, v int")
    sync.upsert_stream(stream, "operations.live", "k", "seq", str(tmp_path / "chk")).awaitTermination(120)
    land("c", [("b", 4, 40), ("c", 1, 7)], "k string, seq int, v int")
    sync.upsert_stream(stream, "operations.live", "k", "seq", str(tmp_path / "chk")).awaitTermination(120)
    assert rows(stores.table("operations.live"), "k", "v") == [("a", 20), ("b", 50), ("c", 7)]


def test_upsert_stream_deletes(stores, land, tmp_path, rows):
    schema = "k string, seq int, op string, v int"
    stream = land("d", [("a", 1, "I", 10), ("b", 1, "I", 1)], schema)
    args = ("operations.gone", "k", "seq", str(tmp_path / "chk"), None, "op")
    sync.upsert_stream(stream, *args).awaitTermination(120)
    land("d", [("a", 3, "D", None)], schema)
    sync.upsert_stream(stream, *args).awaitTermination(120)
    land("d", [("a", 2, "U", 20)], schema)
    sync.upsert_stream(stream, *args).awaitTermination(120)
    assert rows(sinks.live(stores, "operations.gone"), "k", "v") == [("b", 1)]


def test_log_stream_is_idempotent(stores, land, tmp_path):
    def line(key):
        return tuple(key if f.name == "log_id" else None for f in AUDIT_LOGS.fields)

    stream = land("f", [line("1"), line("2")], AUDIT_LOGS)
    audit.log_stream(stream, "audit.audit_logs", str(tmp_path / "chk")).awaitTermination(120)
    audit.log_stream(stream, "audit.audit_logs", str(tmp_path / "another")).awaitTermination(120)
    assert stores.table("audit.audit_logs").count() == 2


def test_incremental_sync_reads_each_file_once(spark, tmp_path, rows):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.csv").write_text("VBELN,AUDAT,GBSTK\n001,20240110,C\n002,20230101,A\n")
    args = (spark, str(landing), ["VBELN", "AUDAT", "GBSTK"], "sap", "sales_orders", str(tmp_path / "t"), str(tmp_path / "k"))
    got = sync.incremental(*args, first_since=D(2024, 1, 1))
    assert rows(got, "order_id", "order_status") == [("1", "COMPLETE")]
    (landing / "2.csv").write_text("VBELN,AUDAT,GBSTK\n003,20240111,D\n")
    got = sync.incremental(*args, first_since=D(2024, 1, 1))
    assert rows(got, "order_id", "order_status") == [("1", "COMPLETE"), ("3", "CANCELED")]
    assert rows(sync.full_load(got, "order_date", D(2024, 2, 9), 30), "order_id") == [("1",), ("3",)]


def test_orphans_are_withdrawn_however_late_the_partner_comes(spark, land, tmp_path, rows):
    ten = Decimal("10.00")
    table = MergeTable(spark, str(tmp_path / "table"), "order_id", buckets=2)

    def run(orders, invoices):
        query = reconcile.correct(land("o", orders, ORDERS), land("i", invoices, INVOICES), table, str(tmp_path / "cp"), str(tmp_path / "log"))
        query.awaitTermination(120)
        return {r.order_id: r.status for r in table.read().collect()}

    order = lambda key, day: (key, D(2024, 1, day), ten, "n", "COMPLETE")
    bill = lambda key, day, amount=ten: (key, D(2024, 1, day), amount, "Paid")
    assert run([order("a", 1), order("b", 1), (None, D(2024, 1, 1), ten, "n", "COMPLETE")], [bill("b", 1), bill("c", 2)]) == {"a": "OPS_ONLY", "b": "OK", "c": "FIN_ONLY"}
    assert run([order("c", 1), order("b", 1)], [(None, D(2024, 1, 1), ten, "Paid")]) == {"a": "OPS_ONLY", "b": "OK", "c": "OK"}
    land("o", [order("z", 30)], ORDERS)
    assert run([], [bill("a", 28, Decimal("11.00"))]) == {"a": "AMOUNT_MISMATCH", "b": "OK", "c": "OK", "z": "OPS_ONLY"}
    log = spark.read.parquet(str(tmp_path / "log")).select("batch", "op", "order_id", "status")
    assert rows(log) == sorted([
        (0, "+", "a", "OPS_ONLY"), (0, "+", "b", "OK"), (0, "+", "c", "FIN_ONLY"), (1, "-", "c", "FIN_ONLY"), (1, "+", "c", "OK"),
        (2, "-", "a", "OPS_ONLY"), (2, "+", "a", "AMOUNT_MISMATCH"), (2, "+", "z", "OPS_ONLY")], key=repr)
    batch = recon.full(spark.read.schema(ORDERS).parquet(str(tmp_path / "o")).dropna(subset=["order_id"]).distinct(), spark.read.schema(INVOICES).parquet(str(tmp_path / "i")).dropna(subset=["order_id"]))
    assert rows(table.read(), *sorted(batch.columns)) == rows(batch, *sorted(batch.columns))


def test_orders_of_several_lines_count_once(land, tmp_path, rows):
    data = [(k // 3, "u", "read", at(1, 5)) for k in range(18)] + [(k, "v", "read", at(1, 7)) for k in range(5)] + [(999, "end", "x", at(20))]
    land("e", data, EVENTS)
    stream = land("e", data, EVENTS)  # everything once more
    found = finish(monitors.order_frequency(stream, "ts", "user", limit=4, order="event_id"), tmp_path, "freq")
    assert rows(found) == [(D(2024, 1, 1), "u", 6, "LOW"), (D(2024, 1, 1), "v", 5, "LOW")]


def test_panes_take_late_rows(spark, land, tmp_path, rows):
    store = panes.PaneStore(spark, str(tmp_path / "store"))

    def run(data):
        panes.run(store, land("e", data, EVENTS), "ts", "user", "kind", str(tmp_path / "cp")).awaitTermination(120)

    run([(k, "u", "read", at(1, 5)) for k in range(3)] + [(9, "u", "read", at(5))])
    run([(20, "u", "write", at(1, 5)), (21, "v", "read", at(4, 23)), (22, None, "read", at(1, 6))])
    found = panes.folded(store.stored())
    assert rows(found.where("hour = '2024-01-01 05:00:00'")) == [(at(1, 5), "u", 4, ["read", "write"])]
    assert rows(panes.late_counts(store.stored())) == [(at(1, 5), 4, 1), (at(1, 6), 1, 1)]
    busy = panes.busy_days(store.stored(), limit=3)
    assert busy.count() == 24 and rows(busy.select("auditor_id", "access_count", "entity_types").distinct()) == [("u", 4, 2)]
    plan = busy._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    before = rows(panes.late_counts(store.stored()))
    store.compact()
    assert rows(panes.late_counts(store.stored())) == before
    store.add(spark.createDataFrame([(1, "u", "x", at(9))], EVENTS), "ts", "user", "kind", 1)  # a repeated batch
    assert rows(panes.late_counts(store.stored())) == before


def test_states_are_not_looked_up_only_to_be_counted():
    assert runner.stream_settings()["spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"] == "false"
