"""Every named query against DuckDB, and known counts of the given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
import registry
from tallywright.session import settings
from tests import oracle

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, SQL = registry.collect().queries, registry.collect().sql

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="given tables not there")


@pytest.fixture(scope="module")
def con():
    return oracle.duck(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@needs_data
@pytest.mark.slow
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, SMALL), con, SQL[name]) == []


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


@needs_data
@pytest.mark.slow
@pytest.mark.parametrize("name", ["orders_shipping", "metrics_all", "recon_match_ledger", "ingest_ledger", "masked_ar"])
def test_shuffled_joins_give_the_same_rows(spark, con, name):
    """The joins of large inputs, forced on the small tables."""
    with settings(spark, NO_BROADCAST):
        assert oracle.compare(QUERIES[name](spark, SMALL), con, SQL[name]) == []


@needs_data
@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if not n.startswith("stream_") and n not in ("findings_not_logged",)])
def test_lines_are_scanned_at_most_twice(spark, name):
    """Three times where several metrics are put together."""
    with settings(spark, NO_BROADCAST):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") == 0 or sum("Relation [l_orderkey" in line for line in plan.splitlines()) <= (3 if name.startswith("metrics") else 2)


@needs_data
def test_known_counts(spark):
    row = QUERIES["recon_summary"](spark, MIDDLE).collect()[0]
    assert (row.ops_orders, row.missing_in_fin, row.ghost_invoices) == (9802, 275, 149)
    assert QUERIES["recon_orphan_orders"](spark, MIDDLE).count() == 192
    scores = {r.rule_type: r for r in QUERIES["metrics_all"](spark, MIDDLE).collect()}
    timing = scores["timing_fraud"]
    assert (timing.true_positives, timing.false_positives, timing.true_negatives) == (18925, 113, 20060)
    newest = QUERIES["pnl_monthly"](spark, MIDDLE).collect()[0]
    assert (newest.month, newest.order_count, newest.revenue, newest.net_profit) == ("2001-07", 133, 33023442.27, 14965261.0113)


@needs_data
def test_entry(spark):
    assert contract.entry(spark).count() > 0
