"""Money, ratios and tolerances."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

from tallywright.schemas import MONEY

AMOUNT_TOLERANCE = Decimal("0.01")


def to_money(c: Column) -> Column:
    """Text or number to DECIMAL(18,2); NaN and unreadable text become NULL."""
    return c.try_cast(MONEY)


def to_whole(c: Column) -> Column:
    """Text or number to int, cutting decimals off; unreadable text becomes NULL."""
    return c.try_cast("double").try_cast("int")


def ratio(top: Column, bottom: Column, digits: int | None = None) -> Column:
    """``top / bottom`` as double, 0.0 where the bottom is 0 or NULL."""
    value = F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
    return F.bround(value, digits) if digits is not None else value


def margin_pct(profit: Column, sales: Column) -> Column:
    """Profit in percent of sales, half-even to 2 digits; NULL where sales are 0."""
    return F.bround(F.try_divide(profit.cast("double"), sales.cast("double")) * 100, 2)


def margin_pct_guarded(profit: Column, sales: Column) -> Column:
    """Profit in percent of sales, 0 where sales are not positive."""
    share = F.try_divide(profit.cast("double"), sales.cast("double")) * 100
    return F.when(sales > 0, share).otherwise(F.lit(0.0))


def amount_differs(
    left: Column,
    right: Column,
    tolerance: Decimal = AMOUNT_TOLERANCE,
    tie_differs: bool = False,
) -> Column:
    """True where the amounts are further apart than the tolerance.

    ``tie_differs`` makes a gap of exactly the tolerance count as a difference.
    A missing amount is never a difference.
    """
    gap = F.abs(left - right)
    verdict = gap >= F.lit(tolerance) if tie_differs else gap > F.lit(tolerance)
    return F.coalesce(verdict, F.lit(False))
