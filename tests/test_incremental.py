"""The kept comparison and incremental loads."""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.operators import recon
from tallywright.sources.append_log import AppendLog
from tallywright.sources.comparison import Comparison
from tallywright.sources.manifest import Conflict
from tallywright.streaming import sync

ORDERS = "order_id string, order_date date, customer_name string, sales decimal(18,2), order_status string, seq long, gone boolean"
INVOICES = "order_id string, invoice_date date, invoice_amount decimal(18,2), payment_status string, seq long, gone boolean"
DAY = dt.date(2024, 1, 1)


def changes(rng, n, number):
    """Random changes of both sides over few ids, out of order, with deletes, nulls and rows without an id."""
    seqs = rng.sample(range(number * 5, number * 5 + 1000), 2 * n)

    def some(*values):
        return rng.choice([None, *values])

    orders = [
        (f"o{rng.randint(0, 20)}", some(DAY), some("x"), some(Decimal(10), Decimal(20)), some("COMPLETE", "CANCELED"), s, rng.random() < 0.2)
        for s in seqs[:n]
    ]
    invoices = [
        (f"o{rng.randint(5, 25)}", DAY + dt.timedelta(days=rng.randint(0, 3)), some(Decimal(10), Decimal(21)), some("Paid", "Cancelled"), s, rng.random() < 0.2)
        for s in seqs[n:]
    ]
    return orders + [(None, DAY, "x", Decimal(1), "COMPLETE", 1, False)], invoices


def newest(state, rows):
    for row in rows:
        if row[0] is not None and (row[0] not in state or row[-2] > state[row[0]][-2]):
            state[row[0]] = row
    return [row for row in state.values() if not row[-1]]


def whole(spark, orders, invoices):
    return recon.full(spark.createDataFrame(orders, ORDERS), spark.createDataFrame(invoices, INVOICES))


def same(kept, expected, rows):
    assert rows(kept.read(), *expected.columns) == rows(expected)
    for got, wanted in (
        (kept.summary(), recon.summary(expected)),
        (kept.audit_row("2024-02-01 00:00:00"), recon.audit_row(expected, "2024-02-01 00:00:00")),
        (kept.control_report(), recon.control_report(expected)),
    ):
        assert got.columns == wanted.columns and rows(got) == rows(wanted)


def test_kept_comparison_equals_the_full_one_after_every_change_set(spark, tmp_path, rows):
    rng, kept = random.Random(3), Comparison(spark, str(tmp_path), buckets=4)
    ops, fin = {}, {}
    for number in range(4):
        orders, invoices = changes(rng, 25 if number == 0 else 6, number)
        if number == 2:
            orders = []
        frames = spark.createDataFrame(orders, ORDERS), spark.createDataFrame(invoices, INVOICES)
        assert kept.apply(*frames, number, gone=F.col("gone"))
        assert not kept.apply(*frames, number, gone=F.col("gone"))
        if number == 1:
            kept.compact()
        same(kept, whole(spark, newest(ops, orders), newest(fin, invoices)), rows)
    with pytest.raises(ValueError, match="change set 4 comes before 6"):
        kept.apply(*frames, 6, gone=F.col("gone"))


def test_a_change_set_that_broke_off_counts_once(spark, tmp_path, rows, monkeypatch):
    rng, kept = random.Random(5), Comparison(spark, str(tmp_path), buckets=2)
    ops, fin = {}, {}
    for number in range(2):
        orders, invoices = changes(rng, 12, number)
        frames = spark.createDataFrame(orders, ORDERS), spark.createDataFrame(invoices, INVOICES)
        for table in (kept.orders, kept.invoices, kept.rows):
            with monkeypatch.context() as m:
                m.setattr(table.manifest, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    kept.apply(*frames, number, gone=F.col("gone"))
        assert kept.apply(*frames, number, gone=F.col("gone"))
        same(kept, whole(spark, newest(ops, orders), newest(fin, invoices)), rows)


def test_without_changes_and_without_rows(spark, tmp_path, rows):
    kept = Comparison(spark, str(tmp_path), buckets=2)
    none = spark.createDataFrame([], ORDERS), spark.createDataFrame([], INVOICES)
    assert kept.apply(*none, 0, gone=F.col("gone"))
    same(kept, whole(spark, [], []), rows)


def test_change_sets_read_only_the_buckets_they_touch(spark, tmp_path):
    kept = Comparison(spark, str(tmp_path), buckets=16)
    orders = [(f"o{n}", DAY, "x", Decimal(n), "COMPLETE", 1, False) for n in range(200)]
    kept.apply(spark.createDataFrame(orders, ORDERS), spark.createDataFrame([], INVOICES), 0)
    one = spark.createDataFrame([("o7",)], "order_id string")
    plan = kept.rows.read_keys(one)._jdf.queryExecution().executedPlan().toString()
    (bucket,) = one.select(kept.rows._bucket(16)).first()
    assert f"_bucket#" in plan and f"= {bucket})" in plan.split("PartitionFilters:")[1].split("]")[0]  # other buckets are not listed
    before = {b: s["delta_rows"] for b, s in kept.rows.manifest.read()[1]["buckets"].items()}
    kept.apply(spark.createDataFrame([("o7", DAY, "x", Decimal(8), "COMPLETE", 2, False)], ORDERS), spark.createDataFrame([], INVOICES), 1)
    after = {b: s["delta_rows"] for b, s in kept.rows.manifest.read()[1]["buckets"].items()}
    assert {b for b in after if after[b] != before[b]} == {str(bucket)}


def test_rows_are_not_written_over_a_newer_version(spark, tmp_path):
    kept = Comparison(spark, str(tmp_path), buckets=2)
    kept.apply(spark.createDataFrame([("a", DAY, "x", Decimal(1), "COMPLETE", 1, False)], ORDERS), spark.createDataFrame([], INVOICES), 0)
    with pytest.raises(Conflict):
        kept.rows.upsert(kept.read().withColumn("n", F.lit(9)), "n", after=0)


EVENTS = "id long, v string, ts timestamp"


def events(spark, *rows):
    return spark.createDataFrame([(i, v, dt.datetime.fromisoformat(t)) for i, v, t in rows], EVENTS)


@pytest.fixture
def feed(spark, tmp_path):
    log = AppendLog(spark, str(tmp_path / "log"), "content", F.date_format("ts", "yyyy-MM-dd"), prefixes=2)
    marks = sync.Marks(spark, str(tmp_path / "marks"))

    def load(source, as_of, **more):
        return sync.load_new(source, "ts", log, marks, "sap", "orders", dt.datetime.fromisoformat(as_of), **more)

    return log, marks, load


def test_first_load_goes_one_day_back_and_later_ones_overlap(spark, feed):
    log, marks, load = feed
    old, new = (1, "a", "2024-01-01 11:00:00"), (2, "a", "2024-01-02 11:50:00")
    first = load(events(spark, old, new), "2024-01-02 12:00:00")
    assert (first.rows_read, first.rows_new) == (1, 1) and first.mark == "2024-01-02 11:50:00"
    # A row of before the mark that only now is seen, a row read again, a change of a row, one that is still to come.
    late, change, ahead = (3, "a", "2024-01-02 11:10:00"), (2, "b", "2024-01-02 12:30:00"), (4, "a", "2024-01-02 13:00:00")
    second = load(events(spark, old, new, late, change, ahead), "2024-01-02 13:00:00")
    assert (second.rows_read, second.rows_new, second.mark) == (3, 2, "2024-01-02 12:30:00")
    assert sorted((r.id, r.v) for r in log.read().collect()) == [(2, "a"), (2, "b"), (3, "a")]
    assert sorted((r.id, r.v) for r in sync.current_state(log.read(), "id", "ts").collect()) == [(2, "b"), (3, "a")]
    assert marks.loads("sap", "orders") == [first, second] and marks.read("oracle", "orders") == (0, None)


def test_a_load_that_broke_off_before_its_mark_adds_nothing_twice(spark, feed, monkeypatch):
    log, marks, load = feed
    rows = events(spark, (1, "a", "2024-01-02 11:00:00"), (1, "a", "2024-01-02 11:00:00"), (2, "a", "2024-01-02 11:30:00"))
    with monkeypatch.context() as m:
        m.setattr(sync.Marks, "move", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            load(rows, "2024-01-02 12:00:00")
    assert log.read().count() == 2 and marks.read("sap", "orders") == (0, None)
    again = load(rows, "2024-01-02 12:00:00")
    assert (again.rows_read, again.rows_new) == (3, 0) and log.read().count() == 2


def test_marks_stay_without_new_rows_and_two_loads_at_once_conflict(spark, feed):
    log, marks, load = feed
    rows = events(spark, (1, "a", "2024-01-02 11:00:00"))
    assert load(rows, "2024-01-01 00:00:00") == sync.Load("2023-12-31 00:00:00", "2024-01-01 00:00:00", 0, 0, None)
    load(rows, "2024-01-02 12:00:00")
    idle = load(rows.where("id > 1"), "2024-01-03 12:00:00")
    assert idle.rows_read == 0 and idle.mark == "2024-01-02 11:00:00"
    version, _ = marks.read("sap", "orders")
    with pytest.raises(Conflict):
        marks.move("sap", "orders", version - 1, idle)
