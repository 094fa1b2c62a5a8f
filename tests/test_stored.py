"""Tables with a manifest: merge on read, append once."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.session import settings
from tallywright.sources import append_log
from tallywright.sources.append_log import AppendLog
from tallywright.sources.manifest import Conflict, Manifest
from tallywright.sources.merge_table import MergeTable
from tallywright.streaming import audit, runner, sync

SCHEMA = "k string, v int, seq long, op string"


def live(table, version=None):
    return {r.k: r.v for r in table.read(version).collect()}


def test_manifest_lets_one_of_two_writers_through(spark, tmp_path):
    one, two = Manifest(spark, str(tmp_path)), Manifest(spark, str(tmp_path))
    assert one.read() == (0, {})
    assert one.commit(0, {"a": 1}) == 1 and two.read() == (1, {"a": 1})
    two.commit(1, {"a": 2})
    with pytest.raises(Conflict):
        one.commit(1, {"a": 3})
    assert one.read() == (2, {"a": 2}) and one.read(1) == (1, {"a": 1})


def test_manifest_passes_over_a_version_that_broke_off(spark, tmp_path):
    manifest = Manifest(spark, str(tmp_path))
    manifest.commit(0, {"a": 1})
    (tmp_path / "versions" / "000000000002.json").write_text('{"a":')
    assert manifest.read() == (1, {"a": 1})
    with pytest.raises(Conflict):  # it may still be at work
        manifest.commit(1, {"a": 2})
    manifest.given_up_after = -1.0
    assert manifest.commit(1, {"a": 2}) == 3 and manifest.read() == (3, {"a": 2})


def test_merge_table_against_a_dictionary(spark, tmp_path):
    """Random changes out of order, deletes, repeated batches and compactions in between."""
    rng = random.Random(1)
    table, state, done = MergeTable(spark, str(tmp_path / "t"), "k", buckets=4), {}, []
    for number in range(5):
        batch = [(f"k{rng.randint(0, 12)}", rng.randint(0, 99), rng.randint(0, 60), rng.choice("UUUD")) for _ in range(15)]
        batch = list({(k, s): (k, v, s, op) for k, v, s, op in batch}.values()) + [(None, 1, 99, "U")]
        for k, v, s, op in sorted(batch, key=lambda r: r[2]):
            if k is not None and (k not in state or s > state[k][0]):
                state[k] = (s, None if op == "D" else v)
        done.append(batch)
        frame = spark.createDataFrame(batch, SCHEMA)
        assert table.upsert(frame, "seq", F.col("op") == "D", ("feed", number))
        if number == 2:
            table.compact()
        if number == 3:
            assert not table.upsert(frame, "seq", F.col("op") == "D", ("feed", number))
            assert table.upsert(spark.createDataFrame(done[0], SCHEMA), "seq", F.col("op") == "D")  # older than what is there
        assert live(table) == {k: v for k, (_, v) in state.items() if v is not None}
    before = live(table)
    table.compact(share=0)
    assert live(table) == before and table.compact() == []
    gone = table.vacuum(keep=1)
    assert gone and live(table) == before


def test_a_crash_before_the_manifest_loses_and_doubles_nothing(spark, tmp_path, monkeypatch):
    table = MergeTable(spark, str(tmp_path / "t"), "k", buckets=2)
    table.upsert(spark.createDataFrame([("a", 1, 1, "U"), ("b", 1, 0, "U")], SCHEMA), "seq")
    table.upsert(spark.createDataFrame([("b", 2, 1, "U")], SCHEMA), "seq")
    change = spark.createDataFrame([("a", 5, 2, "U"), ("c", 3, 2, "U")], SCHEMA)

    def broken(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(table.manifest, "commit", broken)
        with pytest.raises(OSError):
            table.upsert(change, "seq", batch=("feed", 1))
        with pytest.raises(OSError):
            table.compact(share=0)
    assert live(table) == {"a": 1, "b": 2}
    assert table.upsert(change, "seq", batch=("feed", 1)) and not table.upsert(change, "seq", batch=("feed", 1))
    assert live(table) == {"a": 5, "b": 2, "c": 3} and live(table, 2) == {"a": 1, "b": 2} and live(table, 1) == {"a": 1, "b": 1}
    table.vacuum()
    assert live(table) == {"a": 5, "b": 2, "c": 3}


def test_compaction_takes_only_buckets_with_many_changes(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), "k", buckets=8)
    table.upsert(spark.createDataFrame([(f"k{n}", n, 1, "U") for n in range(200)], SCHEMA), "seq")
    assert table.compact() == []  # first rows are a base already
    table.upsert(spark.createDataFrame([("k7", 0, 2, "U")] + [(f"k{n}", 0, 2, "U") for n in range(3)], SCHEMA), "seq")
    assert table.compact() == []  # under a quarter everywhere
    assert live(table)["k7"] == 0
    buckets = table.manifest.read()[1]["buckets"]
    assert sum(bool(b["deltas"]) for b in buckets.values()) <= 4
    assert 1 <= len(table.compact(share=0)) <= 4


def test_upserts_from_a_stream(spark, tmp_path):
    land = tmp_path / "in"
    sets = [[("a", 1, 5, "U"), ("b", 1, 5, "U")], [("a", 0, 3, "U"), ("b", 0, 9, "D")], [("b", 7, 8, "U"), ("c", 1, 1, "U")]]
    for n, rows in enumerate(sets):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(land))
        table = MergeTable(spark, str(tmp_path / "t"), "k", buckets=2)
        stream = runner.read_files(spark, str(land), spark.createDataFrame([], SCHEMA).schema, max_files=1)
        sync.upsert_stream(stream, table, "k", "seq", str(tmp_path / "cp"), op="op").awaitTermination()
    assert live(table) == {"a": 1, "c": 1}
    assert table.manifest.read()[1]["applied"] == {str(tmp_path / "cp"): 2}


def log_of(spark, tmp_path, prefixes=4):
    return AppendLog(spark, str(tmp_path / "log"), "id", F.col("day"), prefixes)


def rows_of(spark, ids, day):
    return spark.createDataFrame([(i, day, f"note {i}") for i in ids], "id string, day string, note string")


def test_append_log_takes_each_id_once(spark, tmp_path):
    log = log_of(spark, tmp_path)
    assert log.append(rows_of(spark, ["a", "b", "b", None], "d1")) == 2
    assert log.append(rows_of(spark, ["b", "c"], "d2")) == 1
    assert log.append(rows_of(spark, ["a", "b", "c"], "d9")) == 0
    assert sorted((r.id, r.day) for r in log.read().collect()) == [("a", "d1"), ("b", "d1"), ("c", "d2")]
    log.compact()
    assert len(log.manifest.read()[1]["parts"]) == 1
    assert log.append(rows_of(spark, ["c", "d"], None)) == 1 and log.read().count() == 4


def test_filters_err_as_seldom_as_promised():
    rng = np.random.default_rng(1)
    one, two, other, more = rng.integers(-(2**63), 2**63, (4, 2000))
    bits = np.zeros(append_log._bits(2000), bool)
    bits[append_log._probes(one, two, len(bits)).ravel()] = True
    packed = np.packbits(bits).tobytes()
    assert append_log._known(packed, 2000, one, two).all()
    many = [append_log._known(packed, 2000, other + k, more - k).sum() for k in range(100)]
    assert sum(many) <= 3  # of 200,000


def test_append_log_reads_only_slots_that_may_hold_an_id(spark, tmp_path):
    log = log_of(spark, tmp_path, prefixes=8)
    for n in range(4):
        log.append(rows_of(spark, [f"{n}-{k}" for k in range(500)], f"d{n}"))
    _, content = log.manifest.read()
    assert log.slots_asked(rows_of(spark, [f"new-{k}" for k in range(2000)], "d9")) == []
    (slot,) = log.slots_asked(rows_of(spark, ["2-17", "other"], "d9"))
    assert slot.startswith("d2_")
    data = log._data(content, [slot])
    assert data.where("id = '2-17'").count() == 1
    plan = data._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_slot" in plan and f"(_slot#" in plan and f"= {slot})" in plan  # partitions are pruned
    assert log.append(rows_of(spark, [f"1-{k}" for k in range(500)] + ["x"], "d5")) == 1


def test_findings_logged_from_a_stream_with_replays(spark, tmp_path):
    land, log = tmp_path / "in", log_of(spark, tmp_path)
    for ids in (["a", "b"], ["b", "c"], ["a", "c"]):
        rows_of(spark, ids, "d").coalesce(1).write.mode("append").parquet(str(land))
    for checkpoint in ("one", "two"):  # the second starts afresh and replays everything
        stream = runner.read_files(spark, str(land), rows_of(spark, [], "d").schema, max_files=1)
        audit.log_stream(stream, log, str(tmp_path / checkpoint)).awaitTermination()
        assert sorted(r.id for r in log.read().collect()) == ["a", "b", "c"]


SPREAD = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}


def test_a_bucket_is_written_by_many_tasks(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), "k", buckets=2)
    with settings(spark, SPREAD):
        table.upsert(spark.createDataFrame([(f"k{n}", n, 1, "U") for n in range(2000)], SCHEMA), "seq")
    folders = list((tmp_path / "t").glob("delta-*/_bucket=*"))
    assert len(folders) == 2 and all(len(list(f.glob("part-*"))) > 1 for f in folders)
    assert len(live(table)) == 2000


def test_base_and_changes_meet_in_one_join(spark, tmp_path):
    table = MergeTable(spark, str(tmp_path / "t"), "k", buckets=2)
    table.upsert(spark.createDataFrame([("a", 1, 1, "U"), ("b", 1, None, "U"), ("c", 1, 5, "U"), ("f", None, None, "U")], SCHEMA), "seq")
    table.upsert(spark.createDataFrame([("a", 2, None, "U"), ("b", None, 0, "U"), ("c", 9, 5, "U"), ("d", 4, None, "U"), ("f", 3, None, "U")], SCHEMA), "seq")
    rows = table.read()
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    assert live(table) == {"a": 1, "b": None, "c": 1, "d": 4, "f": None}
    plan = rows.select("k")._jdf.queryExecution().executedPlan().toString()
    assert any(",v:" not in scan for scan in plan.split("ReadSchema: ")[1:])  # the base's columns that are not asked for are not read


def test_findings_are_made_once_for_three_days(spark, monkeypatch):
    from registry import governance as queries

    made = spark.createDataFrame([(str(n), "R", str(n)) for n in range(9)], "log_id string, action string, entity_id string")
    monkeypatch.setattr(queries, "_findings", lambda *_: made)
    plans, append = [], AppendLog.append
    monkeypatch.setattr(AppendLog, "append", lambda log, batch, *more: plans.append(batch._jdf.queryExecution().executedPlan().toString()) or append(log, batch, *more))
    got = queries.append_log(spark, "")
    assert len(plans) == 3 and all("InMemoryTableScan" in plan for plan in plans)
    assert not made.select("log_id", "action", "entity_id").storageLevel.useMemory
    assert sorted((r.log_id, r.day) for r in got.collect()) == [(str(n), f"2002-01-0{n % 3 + 1}") for n in range(9)]
