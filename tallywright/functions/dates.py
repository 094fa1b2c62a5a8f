"""Dates: tolerant parsing, day gaps, months and periods."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column, functions as F

# Spellings other than ISO and how they become ISO.
_TO_ISO = (
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"),
    (r"^(\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
)


# A four-digit year, month and day, alone or before a time of day.
_ISO_DATE = r"^(\d{4}-\d{1,2}-\d{1,2})(?:[T ]+\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?: ?[AaPp][Mm])?(?:Z|[+-]\d{2}:?\d{2})?)?$"


def parse_date(c: Column) -> Column:
    """Text to date, NULL when it is none.

    Reads ``2018-01-31``, ``2018/1/31``, ``20180131`` and ``1/31/2018``, each with or
    without a time of day behind it.  The text is brought to ISO order and cast: unlike
    a list of date formats that costs no exception per miss, and the input expression
    occurs only once.  Anything else before, between or behind is no date: neither a
    spreadsheet's day number nor a date with words after it.
    """
    text = F.trim(c)
    for pattern, iso_order in _TO_ISO:
        text = F.regexp_replace(text, pattern, iso_order)
    return F.regexp_extract(text, _ISO_DATE, 1).try_cast("date")


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded down.

    Dates go through ``datediff``; use :func:`floor_days` when the columns carry
    a time of day.
    """
    return F.datediff(later, earlier)


def floor_days(later: Column, earlier: Column) -> Column:
    """Whole days between two timestamps, rounded towards minus infinity."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(micros / F.lit(86_400_000_000)).cast("int")


def month_label(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def between_dates(c: Column, start: str | dt.date | None, end: str | dt.date | None) -> Column:
    """Inclusive date range; applied only when both ends are given."""
    if start is None or end is None:
        return F.lit(True)
    return c.between(F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))


def period_bounds(year: int, month: int | None = None) -> tuple[dt.date, dt.date]:
    """First and last day of a year or of one month in it."""
    first = dt.date(year, month or 1, 1)
    last_month = month or 12
    return first, dt.date(year, last_month, calendar.monthrange(year, last_month)[1])


def days_before(as_of: str | dt.datetime, days: int) -> Column:
    """Literal moment ``days`` before ``as_of``."""
    moment = as_of if isinstance(as_of, dt.datetime) else dt.datetime.fromisoformat(str(as_of))
    return F.lit((moment - dt.timedelta(days=days)).isoformat(" "))
