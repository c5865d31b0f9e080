"""Registered queries with the SQL that checks them."""

from __future__ import annotations

from marketframe.catalog.registry import ORACLES, QUERIES


def load() -> tuple[dict, dict]:
    """All queries and all check statements, by name."""
    from marketframe.catalog import (  # noqa: F401
        aggregates, bundles, contracts, documents, jobs, lookups, scans, screens, shapes, status, streams, studies,
    )

    return dict(QUERIES), dict(ORACLES)
