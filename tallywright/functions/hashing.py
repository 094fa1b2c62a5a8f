"""Stable identifiers and row digests."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def content_id(*parts: Column | str) -> Column:
    """SHA-256 over the parts, NULL written as an empty text between bars."""
    texts = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def row_digest(columns: list[str]) -> Column:
    """SHA-256 over the row as JSON with sorted keys, NULL fields included."""
    ordered = F.struct(*(F.col(c) for c in sorted(columns)))
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)
