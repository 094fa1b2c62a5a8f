from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.operators import metrics, quality, reports, rules

D = dt.date
ORDERS = "order_id string, order_date date, profit decimal(18,2), sales decimal(18,2), order_status string, customer_name string, customer_country string"
SHIPMENTS = "order_id string, log_id string, shipping_date date"


def orders_of(spark, profits, status="COMPLETE"):
    data = [
        (f"o{i}", D(2024, 1, 10), Decimal(p), Decimal("100.00"), status, "n", "c") for i, p in enumerate(profits)
    ]
    return spark.createDataFrame(data, ORDERS)


def shipped(spark, gaps):
    data = [(f"o{i}", f"s{i}", D(2024, 1, 10) + dt.timedelta(days=g) if g is not None else None) for i, g in enumerate(gaps)]
    return spark.createDataFrame(data, SHIPMENTS)


def test_timing(spark):
    lines = rules.orders_shipping(orders_of(spark, ["1"] * 6), shipped(spark, [-8, -7, -1, 0, 1, None]))
    found = {r.order_id: (r.days_early, r.severity) for r in rules.timing(lines).collect()}
    assert found == {"o0": (8, "CRITICAL"), "o1": (7, "CRITICAL"), "o2": (1, "CRITICAL")}


def test_timing_scores(spark):
    row = metrics.timing_rule(orders_of(spark, ["1"] * 6), shipped(spark, [-8, -7, -1, 0, 1, None])).collect()[0]
    assert (row.true_positives, row.false_positives, row.true_negatives, row.false_negatives) == (1, 2, 3, 0)
    assert (row.precision, row.recall, row.f1_score, row.accuracy) == (0.3333, 1.0, 0.5, 0.6667)
    assert row.evaluation_period == "all"


def test_margin_scores(spark):
    row = metrics.margin_rule(orders_of(spark, ["-1000.01", "-1000", "-0.01", "0"])).collect()[0]
    assert (row.true_positives, row.false_positives, row.true_negatives, row.false_negatives) == (1, 2, 1, 0)


def test_labels_replace_the_guess(spark):
    labels = spark.createDataFrame([("o0", False), ("o3", True)], "order_id string, is_fraud boolean")
    row = metrics.margin_rule(orders_of(spark, ["-2000", "-5", "1", "2"]), labels=labels).collect()[0]
    assert (row.true_positives, row.false_positives, row.true_negatives, row.false_negatives) == (0, 2, 1, 1)


def test_scores_of_nothing_are_zero(spark):
    both = metrics.evaluate_all(orders_of(spark, []), shipped(spark, []), D(2024, 1, 1), D(2024, 1, 31)).collect()
    assert [r.rule_type for r in both] == ["timing_fraud", "negative_margin"]
    for row in both:
        assert row.evaluation_period == "2024-01-01 to 2024-01-31"
        assert all(row[c] == 0 for c in ("true_positives", "true_negatives", *metrics.RATIOS))


def test_one_sided_range_is_no_range(spark):
    assert metrics.margin_rule(orders_of(spark, ["-5"]), start="2030-01-01").collect()[0].false_positives == 1


def test_alerts_and_stored_rows(spark):
    scores = metrics.evaluate_all(orders_of(spark, ["-5", "5"]), shipped(spark, [1, -9]))
    flags = {r.rule_type: (r.too_many_false_alarms, r.misses_too_much) for r in metrics.with_alerts(scores).collect()}
    assert flags == {"timing_fraud": (False, False), "negative_margin": (True, True)}
    stored = metrics.to_table(scores, "2024-02-01").collect()
    config = json.loads(next(r.threshold_config for r in stored if r.rule_type == "timing_fraud"))
    assert config["levels"]["CRITICAL"] == [None, 0]
    assert len({r.metric_id for r in stored}) == 2
    with pytest.raises(ValueError):
        metrics.evaluate_all(orders_of(spark, []), shipped(spark, []), enabled=())


def test_loss_and_worst(spark):
    orders = orders_of(spark, ["-30", "-10", "-20", "5", "-10"])
    row = rules.total_loss(rules.negative_margin(orders)).collect()[0]
    assert (row.loss_rows, row.loss_orders, row.total_loss) == (4, 4, Decimal("70.00"))
    assert [r.order_id for r in rules.worst_margins(orders).collect()] == ["o0", "o2", "o1"]
    assert rules.total_loss(rules.negative_margin(orders_of(spark, []))).collect()[0].total_loss == 0
    canceled = orders_of(spark, ["-5"], status="CANCELED")
    assert rules.lowest_margin_orders(canceled).count() == 0


def test_fan_out_counts_lines_and_orders(spark):
    three = spark.createDataFrame([("o0", f"s{i}", D(2024, 1, 1)) for i in range(3)], SHIPMENTS)
    lines = rules.orders_shipping(orders_of(spark, ["-10"]), three)
    row = rules.total_loss(rules.negative_margin(lines)).collect()[0]
    assert (row.loss_rows, row.loss_orders, row.total_loss) == (3, 1, Decimal("30.00"))


def test_zscore(spark):
    df = spark.createDataFrame([(i, 10.0 + i % 2) for i in range(60)] + [(99, 100.0)], "id int, amount double")
    found = rules.amount_zscore(df, "id", "amount").collect()
    assert [(r.id, r.severity) for r in found] == [(99, "CRITICAL")]
    same = spark.createDataFrame([(i, 1.0) for i in range(5)], "id int, amount double")
    assert rules.amount_zscore(same, "id", "amount").count() == 0


def test_frequency_limit_and_bands(spark):
    data = [(f"c{n}", D(2024, 1, 1), f"c{n}-{i}") for n in (10, 11, 15, 30, 50) for i in range(n)] * 2
    df = spark.createDataFrame(data, "customer string, day date, order_id string")
    found = {r.customer: (r.orders, r.severity) for r in rules.order_frequency(df, "customer", F.col("day"), "order_id").collect()}
    assert found == {"c11": (11, "LOW"), "c15": (15, "MEDIUM"), "c30": (30, "HIGH"), "c50": (50, "CRITICAL")}


def test_reports(spark):
    data = [
        ("a", D(2024, 1, 1), Decimal("10"), Decimal("100"), "COMPLETE", "n", "X"),
        ("b", D(2024, 1, 31), Decimal("-20"), Decimal("100"), "PROCESSING", "n", "Y"),
        ("c", D(2024, 2, 1), Decimal("0"), Decimal("0"), "COMPLETE", "n", ""),
        ("d", D(2024, 2, 1), Decimal("50"), Decimal("100"), "CANCELED", "n", "X"),
        ("e", None, Decimal("50"), Decimal("100"), "COMPLETE", "n", None),
    ]
    orders = spark.createDataFrame(data, ORDERS)
    months = [(r.month, r.order_count, r.margin_pct) for r in reports.monthly_pnl(orders).collect()]
    assert months == [("2024-02", 1, None), ("2024-01", 2, -5.0)]
    total = {r.month: (r.order_count, r.margin_pct) for r in reports.pnl_total(orders).collect()}
    assert total == {"2024-02": (1, 0.0), "2024-01": (2, -5.0), "TOTAL": (3, -5.0)}
    assert [(r.region, r.margin_pct) for r in reports.regional_profit(orders).collect()] == [("X", 10.0), ("Y", -20.0)]
    closed = {r.order_status: r.order_count for r in reports.period_close(orders, 2024, 1).collect()}
    assert closed == {"COMPLETE": 1, "PROCESSING": 1}
    assert [r.month for r in reports.monthly_pnl(orders, months=1).collect()] == ["2024-02"]


def test_profile_and_keys(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", float("nan")), (None, 2.0), ("a", 1.0)], "`k 1` string, v double")
    assert rows(quality.null_profile(df)) == [("k 1", 1, 25.0), ("v", 1, 25.0)]
    assert quality.dedupe(df).count() == 3
    assert tuple(quality.dedupe_summary(df).collect()[0]) == (4, 3, 1)
    assert tuple(quality.shape(df).collect()[0]) == (4, 2)
    keyed = df.withColumnRenamed("k 1", "k")
    assert rows(quality.duplicate_keys(keyed, "k")) == [("a", 3)]
    parent = spark.createDataFrame([("b",)], "k string")
    assert rows(quality.orphan_fk(keyed, parent, "k")) == [("a", 3)]
    assert quality.left_join_integrity(parent, parent.unionAll(parent), "k").collect()[0].integrity == "FAILED"


def test_alert_bounds(spark):
    def level(orphans, n):
        data = [("OPS_ONLY" if i < orphans else "OK",) for i in range(n)]
        compared = spark.createDataFrame(data, "status string").selectExpr(
            "status", "true active", "true live", "0 days_apart", "1.0 amount_diff", "1.0 sales"
        )
        return quality.alert_level(compared).collect()[0].alert_level

    assert [level(1, 1000), level(2, 1000), level(6, 1000), level(11, 1000)] == ["NONE", "INFO", "WARNING", "CRITICAL"]
