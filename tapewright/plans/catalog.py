"""Collects the query modules."""

from __future__ import annotations

from tapewright.plans import (  # noqa: F401
    bronze_queries,
    envelope_queries,
    gold_queries,
    market_queries,
    registry,
    stream_queries,
)


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def checks() -> dict[str, str]:
    return dict(registry.CHECKS)
