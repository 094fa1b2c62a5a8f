"""Named queries over the given tables, each with its SQL restatement where SQL can say it."""

from __future__ import annotations

from registry import changes, governance, ingest, quality, reconciliation, reports, rules, streams
from registry.base import Registry

_PARTS = (reconciliation, rules, reports, ingest, quality, governance, changes, streams)


def collect() -> Registry:
    """All parts in one registry."""
    whole = Registry()
    for part in _PARTS:
        whole.merge(part.REGISTRY)
    return whole
