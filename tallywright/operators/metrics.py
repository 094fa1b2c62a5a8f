"""How well the rules do: confusion counts and ratios."""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallywright.functions import bands, dates, money
from tallywright.functions.hashing import content_id
from tallywright.operators import filters, joins

MAX_FALSE_POSITIVE_RATE = 0.05
MIN_RECALL = 0.8

# Trigger limit and bands, stored next to the metrics.
THRESHOLDS = {
    "timing_fraud": (0, bands.TIMING_BANDS),
    "negative_margin": (0, bands.MARGIN_BANDS),
    "amount_anomaly": (3.0, bands.AMOUNT_BANDS),
    "frequency_anomaly": (10, bands.FREQUENCY_BANDS),
}
RATIOS = ("precision", "recall", "f1_score", "false_positive_rate", "false_negative_rate", "accuracy")


def threshold_config(rule: str) -> str:
    """The rule's limit and bands as JSON."""
    limit, levels = THRESHOLDS[rule]
    return json.dumps({"threshold": limit, "levels": {b.level: [b.low, b.high] for b in levels}}, sort_keys=True)


def confusion(df: DataFrame, triggered: Column, fraud: Column, weight: Column | None = None) -> DataFrame:
    """TP, FP, TN, FN in one pass; an unknown value neither triggers nor is fraud.

    ``weight`` counts a row that stands for several.
    """
    t, f = F.coalesce(triggered, F.lit(False)), F.coalesce(fraud, F.lit(False))
    one = F.lit(1) if weight is None else weight

    def n(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, one)), F.lit(0)).cast("bigint")

    return df.agg(
        n(t & f).alias("true_positives"),
        n(t & ~f).alias("false_positives"),
        n(~t & ~f).alias("true_negatives"),
        n(~t & f).alias("false_negatives"),
    )


def derive(counts: DataFrame) -> DataFrame:
    """Add the six ratios, 0.0 on an empty base, half-even to 4 digits."""
    tp, fp = F.col("true_positives"), F.col("false_positives")
    tn, fn = F.col("true_negatives"), F.col("false_negatives")
    precision, recall = money.ratio(tp, tp + fp), money.ratio(tp, tp + fn)
    values = {
        "precision": precision,
        "recall": recall,
        "f1_score": money.ratio(2 * (precision * recall), precision + recall),
        "false_positive_rate": money.ratio(fp, fp + tn),
        "false_negative_rate": money.ratio(fn, fn + tp),
        "accuracy": money.ratio(tp + tn, tp + fp + tn + fn),
    }
    return counts.withColumns({name: F.bround(value, 4) for name, value in values.items()})


def _finish(counts: DataFrame, rule: str, start: object, end: object) -> DataFrame:
    spell = f"{start} to {end}" if start is not None and end is not None else "all"
    scored = derive(counts)
    return scored.select(F.lit(rule).alias("rule_type"), F.lit(spell).alias("evaluation_period"), *scored.columns)


def timing_rule(
    orders: DataFrame,
    shipments: DataFrame,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Score of the timing rule per shipment line.

    Triggered: shipped before the order date.  Fraud: more than 7 days before, or
    the ``labels`` table (order_id, is_fraud) when one is given.
    """
    ops = filters.date_range(filters.active_orders(orders, "strict"), start, end).select("order_id", "order_date")
    if labels is not None:
        ops = joins.outer_join(ops, labels.select("order_id", "is_fraud"), "order_id", "left")
    lines = joins.join_to_unique(shipments.select("order_id", "shipping_date"), ops, "order_id")
    gap = dates.days_between(F.col("shipping_date"), F.col("order_date"))
    fraud = F.col("is_fraud") if labels is not None else gap < -7
    return _finish(confusion(lines, gap < 0, fraud), "timing_fraud", start, end)


def margin_rule(
    orders: DataFrame,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    labels: DataFrame | None = None,
) -> DataFrame:
    """Score of the margin rule per order: triggered below 0, fraud below -1000 or by label."""
    ops = filters.date_range(filters.active_orders(orders, "strict"), start, end).select("order_id", "profit")
    if labels is not None:
        ops = joins.outer_join(ops, labels.select("order_id", "is_fraud"), "order_id", "left")
    fraud = F.col("is_fraud") if labels is not None else F.col("profit") < -1000
    return _finish(confusion(ops, F.col("profit") < 0, fraud), "negative_margin", start, end)


def evaluate_all(
    orders: DataFrame,
    shipments: DataFrame,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    enabled: tuple[str, ...] = ("timing_fraud", "negative_margin"),
) -> DataFrame:
    """One row per enabled rule that has an evaluator; without rows to judge, zeros."""
    known = {
        "timing_fraud": lambda: timing_rule(orders, shipments, start, end),
        "negative_margin": lambda: margin_rule(orders, start, end),
    }
    rows = [known[rule]() for rule in enabled if rule in known]
    if not rows:
        raise ValueError("no enabled rule has an evaluator")
    return reduce(DataFrame.unionByName, rows)


def with_alerts(scores: DataFrame) -> DataFrame:
    """Flag rules with too many false alarms or too many misses."""
    return scores.withColumns(
        {
            "too_many_false_alarms": F.col("false_positive_rate") > MAX_FALSE_POSITIVE_RATE,
            "misses_too_much": F.col("recall") < MIN_RECALL,
        }
    )


def to_table(scores: DataFrame, evaluated_at: str, notes: str | None = None) -> DataFrame:
    """Scores as rows of ``audit.fraud_rule_metrics``, with the thresholds in force."""
    config = F.create_map(*(F.lit(x) for rule in THRESHOLDS for x in (rule, threshold_config(rule))))
    return scores.select(
        content_id("rule_type", "evaluation_period", F.lit(evaluated_at)).alias("metric_id"),
        F.lit(evaluated_at).cast("timestamp").alias("evaluation_date"),
        "rule_type",
        "evaluation_period",
        "true_positives",
        "false_positives",
        "true_negatives",
        "false_negatives",
        *RATIOS,
        F.try_element_at(config, F.col("rule_type")).alias("threshold_config"),
        F.lit(notes).cast("string").alias("notes"),
    )
