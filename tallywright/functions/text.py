"""Text clean-up and masking."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Cell texts that mean "no value" in an extract.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def clean(column: str) -> Column:
    """Trimmed text of a column, NULL for every spelling of a missing value."""
    name = "`" + column.replace("`", "``") + "`"
    missing = ", ".join(f"'{text}'" for text in MISSING_TEXTS)
    text = f"trim(cast({name} as string))"
    return F.expr(f"CASE WHEN {text} NOT IN ({missing}) THEN {text} END")


def mask_name(c: Column) -> Column:
    """First letter and three stars; NULL stays NULL."""
    return F.when(c.isNotNull(), F.concat(F.substring(c, 1, 1), F.lit("***")))


def strip_leading_zeros(c: Column) -> Column:
    """Drop zeros in front, but keep the last one of an all-zero text."""
    return F.regexp_replace(c, "^0+(?!$)", "")
