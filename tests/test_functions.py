from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywright.functions import bands, dates, money, text
from tallywright.functions.hashing import content_id, row_digest


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0].v


@pytest.mark.parametrize(
    ("written", "day"),
    [
        ("2018-01-31", dt.date(2018, 1, 31)),
        ("2018-01-31 22:56:00", dt.date(2018, 1, 31)),
        ("2018-01-31T22:56:00", dt.date(2018, 1, 31)),
        ("1/31/2018 22:56", dt.date(2018, 1, 31)),
        ("01/02/2018", dt.date(2018, 1, 2)),
        ("20180131", dt.date(2018, 1, 31)),
        ("2018/1/31", dt.date(2018, 1, 31)),
        ("99/99/9999", None),
        ("soon", None),
        ("", None),
        (None, None),
        ("43131", None),
        ("2018-01-31 xyz", None),
        ("1/31/20181", None),
        ("x2018-01-31", None),
        ("2018-01-31T10:20:30.5Z", dt.date(2018, 1, 31)),
        ("1/31/2018 10:20 PM", dt.date(2018, 1, 31)),
    ],
)
def test_parse_date(spark, written, day):
    assert one(spark, dates.parse_date(F.lit(written).cast("string"))) == day


@pytest.mark.parametrize(
    ("value", "levels", "level"),
    [
        (-1, bands.TIMING_BANDS, "CRITICAL"),
        (0, bands.TIMING_BANDS, "HIGH"),
        (1, bands.TIMING_BANDS, "MEDIUM"),
        (7, bands.TIMING_BANDS, "LOW"),
        (-1000.01, bands.MARGIN_BANDS, "CRITICAL"),
        (-1000, bands.MARGIN_BANDS, "HIGH"),
        (-500, bands.MARGIN_BANDS, "MEDIUM"),
        (3, bands.AMOUNT_BANDS, "MEDIUM"),
        (4, bands.AMOUNT_BANDS, "HIGH"),
        (5, bands.AMOUNT_BANDS, "CRITICAL"),
        (-2, bands.AMOUNT_BANDS, "LOW"),
        (11, bands.FREQUENCY_BANDS, "LOW"),
        (15, bands.FREQUENCY_BANDS, "MEDIUM"),
        (30, bands.FREQUENCY_BANDS, "HIGH"),
        (50, bands.FREQUENCY_BANDS, "CRITICAL"),
        (None, bands.AMOUNT_BANDS, "LOW"),
    ],
)
def test_severity(spark, value, levels, level):
    assert one(spark, bands.severity(F.lit(value).cast("double"), levels)) == level


def test_money_reads_or_gives_null(spark):
    df = spark.createDataFrame([("12.345",), ("abc",), ("NaN",), ("-3",), (None,)], "t string")
    found = [r[0] for r in df.select(money.to_money(F.col("t"))).collect()]
    assert found == [Decimal("12.35"), None, None, Decimal("-3.00"), None]
    nan = spark.createDataFrame([(float("nan"),)], "x double").select(money.to_money(F.col("x"))).collect()
    assert nan[0][0] is None


def test_whole_numbers_are_cut(spark):
    df = spark.createDataFrame([("3.7",), ("-3.7",), ("abc",)], "t string")
    assert [r[0] for r in df.select(money.to_whole(F.col("t"))).collect()] == [3, -3, None]


def test_amount_tolerance_ties(spark):
    def differs(a, b, tie):
        left, right = (F.lit(Decimal(x)).cast("decimal(18,2)") for x in (a, b))
        return one(spark, money.amount_differs(left, right, tie_differs=tie))

    assert not differs("100.00", "100.01", False)
    assert differs("100.00", "100.02", False)
    assert differs("100.00", "100.01", True)
    missing = money.amount_differs(F.lit(None).cast("decimal(18,2)"), F.lit(Decimal("1.00")))
    assert one(spark, missing) is False


def test_margins(spark):
    assert one(spark, money.margin_pct(F.lit(1.0), F.lit(0.0))) is None
    assert one(spark, money.margin_pct_guarded(F.lit(1.0), F.lit(0.0))) == 0.0
    assert one(spark, money.margin_pct(F.lit(-50.0), F.lit(200.0))) == -25.0
    assert one(spark, money.ratio(F.lit(1), F.lit(0))) == 0.0


def test_text(spark):
    df = spark.createDataFrame([(" Alice ",), ("nan",), ("",), (None,)], "`we``ird name` string")
    assert [r[0] for r in df.select(text.clean("we`ird name")).collect()] == ["Alice", None, None, None]
    assert one(spark, text.mask_name(F.lit("Alice"))) == "A***"
    assert one(spark, text.mask_name(F.lit(None).cast("string"))) is None
    assert one(spark, text.strip_leading_zeros(F.lit("000120"))) == "120"
    assert one(spark, text.strip_leading_zeros(F.lit("000"))) == "0"


def test_floor_days_rounds_down(spark):
    def at(x):
        return F.lit(x).cast("timestamp")

    assert one(spark, dates.floor_days(at("2024-01-01 06:00:00"), at("2024-01-01 12:00:00"))) == -1
    assert one(spark, dates.floor_days(at("2024-01-03 11:00:00"), at("2024-01-01 12:00:00"))) == 1


def test_period_bounds():
    assert dates.period_bounds(2024, 2) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))
    assert dates.period_bounds(2023) == (dt.date(2023, 1, 1), dt.date(2023, 12, 31))


def test_hashes_see_missing_values(spark):
    df = spark.createDataFrame([("a", None), ("a", "")], "x string, y string")
    digests = [r[0] for r in df.select(row_digest(["y", "x"])).collect()]
    assert digests[0] != digests[1]
    assert one(spark, content_id(F.lit("a"), F.lit("b"))) != one(spark, content_id(F.lit("ab"), F.lit("")))
