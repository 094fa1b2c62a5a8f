"""Sealed logs, surges over a run history and orders of several systems."""

from __future__ import annotations

import datetime as dt
import hashlib
import random

from pyspark.sql import functions as F

from tallywright.operators import erp, quality
from tallywright.session import settings
from tallywright.sources import sealed_log
from tallywright.sources.sealed_log import SealedLog


def sealed(spark, folder, rows):
    return SealedLog(spark, str(folder)).seal(spark.createDataFrame(rows, "log_id string, note string"))


def test_equal_logs_have_equal_roots_whatever_their_order(spark, tmp_path):
    rows = [(f"l{n}", f"note {n}") for n in range(300)] + [("none", None)]
    one, two = sealed(spark, tmp_path / "a", rows), sealed(spark, tmp_path / "b", rows[::-1])
    assert one.root() == two.root() and sealed_log.changed_buckets(one, two) == []
    assert sealed_log.differences(one, two).count() == 0
    assert one.rows().count() == 301 and sealed(spark, tmp_path / "c", rows[:0]).root() is None


def test_only_changed_buckets_are_read(spark, tmp_path):
    rows = [(f"l{n}", f"note {n}") for n in range(2000)]
    before = sealed(spark, tmp_path / "a", rows)
    later = [(i, "other") if i == "l7" else (i, t) for i, t in rows if i != "l9"] + [("new", "x")]
    after = sealed(spark, tmp_path / "b", later)
    buckets = sealed_log.changed_buckets(before, after)
    assert 1 <= len(buckets) <= 3
    assert sorted(map(tuple, sealed_log.differences(before, after).collect())) == [("l7", "CHANGED"), ("l9", "DELETED"), ("new", "INSERTED")]
    read = before.rows(buckets)
    assert read.count() < 60
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


SPREAD = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}


def test_a_bucket_is_its_row_digests_in_order_and_no_task_has_all(spark, tmp_path):
    rows = [(f"l{n % 700}", f"note {n}") for n in range(900)] + [(None, "x"), (None, None)]
    with settings(spark, SPREAD):
        log = sealed(spark, tmp_path / "a", rows)
    place = lambda key: hashlib.sha256((key or "").encode()).hexdigest()
    lines = sorted((place(r.log_id), r.row_hash) for r in log.rows().collect())
    buckets = sorted({p[:2] for p, _ in lines})
    want = {b: ([h for p, h in lines if p[:2] == b]) for b in buckets}
    assert {r.prefix: (r.n, r.digest) for r in log.nodes(2).collect()} == {b: (len(hs), hashlib.sha256("".join(hs).encode()).hexdigest()) for b, hs in want.items()}
    assert len(list((tmp_path / "a/tree/2").glob("part-*"))) > 1


def test_few_buckets_are_stored_by_many_tasks(spark, tmp_path):
    with settings(spark, SPREAD):
        SealedLog(spark, str(tmp_path / "a")).seal(spark.createDataFrame([(f"l{n}", "x") for n in range(3000)], "log_id string, note string"), 1)
    assert all(len(list(folder.glob("part-*"))) > 1 for folder in (tmp_path / "a/rows").glob("_bucket=*"))


def test_surges_by_brute_force(spark):
    rng = random.Random(4)
    day = dt.date(2024, 1, 1)
    rows = [(side, day + dt.timedelta(days=7 * n), 40 if n in (3, 30, 31) else rng.randint(0, 9)) for side in "ab" for n in range(60)]
    got = {(r.side, r.run_date): r for r in quality.orphan_surge(spark.createDataFrame(rows, "side string, run_date date, orphans long")).collect()}
    assert len(got) == 120
    for side in "ab":
        seen = []
        for s, d, x in rows:
            if s != side:
                continue
            r, n = got[s, d], len(seen)
            spread = n * sum(v * v for v in seen) - sum(seen) ** 2
            above = n * x - sum(seen)
            assert (r.earlier_runs, r.previous_orphans, r.surge) == (n, seen[-1] if seen else None, n >= 5 and above > 0 and above**2 > 9 * spread)
            assert r.earlier_mean is None if not seen else abs(r.earlier_mean - sum(seen) / n) < 1e-4
            seen.append(x)
    assert got["a", day + dt.timedelta(days=210)].surge
    assert quality.orphan_surge(spark.createDataFrame(rows[:0], "side string, run_date date, orphans long")).count() == 0


def test_fields_of_several_systems_survive_by_rank_and_recency(spark):
    kinds = "order_id string, sales int, currency string, changed_date date"
    old, new = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    sap = spark.createDataFrame([("1", 10, "USD", old), ("2", 20, None, new), ("3", 30, "USD", None), (None, 1, "x", new), ("1", 11, "CHF", old)], kinds).withColumn("only_here", F.lit("p"))
    oracle = spark.createDataFrame([("1", 99, "EUR", new), ("2", None, "EUR", old), ("3", 31, None, None), ("4", 40, "EUR", old)], kinds)
    columns = ("order_id", "sales", "sales_from", "currency", "currency_from", "only_here", "systems")
    got = lambda *prefer: sorted(map(tuple, erp.combine({"sap": sap, "oracle": oracle}, "order_id", "changed_date", *prefer).select(*columns).collect()))
    assert got() == [
        ("1", 99, "oracle", "EUR", "oracle", "p", "oracle,sap"),
        ("2", 20, "sap", "EUR", "oracle", "p", "oracle,sap"),
        ("3", 30, "sap", "USD", "sap", "p", "oracle,sap"),
        ("4", 40, "oracle", "EUR", "oracle", None, "oracle"),
    ]
    assert [r[1:3] for r in got({"sales": ["sap"]})] == [(11, "sap"), (20, "sap"), (30, "sap"), (40, "oracle")]
