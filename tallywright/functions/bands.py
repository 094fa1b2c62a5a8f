"""Severity bands of the rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Band:
    level: str
    low: float | None
    high: float | None


# Level, inclusive lower end, exclusive upper end (None = open).
TIMING_BANDS = (
    Band("CRITICAL", None, 0),
    Band("HIGH", 0, 1),
    Band("MEDIUM", 1, 7),
    Band("LOW", 7, None),
)
MARGIN_BANDS = (
    Band("CRITICAL", None, -1000),
    Band("HIGH", -1000, -500),
    Band("MEDIUM", -500, 0),
    Band("LOW", 0, None),
)
AMOUNT_BANDS = (
    Band("CRITICAL", 5, None),
    Band("HIGH", 4, 5),
    Band("MEDIUM", 3, 4),
    Band("LOW", 0, 3),
)
FREQUENCY_BANDS = (
    Band("CRITICAL", 50, None),
    Band("HIGH", 30, 50),
    Band("MEDIUM", 15, 30),
    Band("LOW", 0, 15),
)


def severity(value: Column, bands: tuple[Band, ...]) -> Column:
    """Level of the first band holding the value; LOW outside all bands or for NULL."""
    chosen = None
    for band in bands:
        inside = F.lit(True)
        if band.low is not None:
            inside = inside & (value >= F.lit(band.low))
        if band.high is not None:
            inside = inside & (value < F.lit(band.high))
        inside = inside & value.isNotNull()
        chosen = F.when(inside, band.level) if chosen is None else chosen.when(inside, band.level)
    return chosen.otherwise(F.lit("LOW"))
