"""The registered queries: each one over the given tables, most with a SQL twin."""

from __future__ import annotations

from martworks.catalog import geo, loads, marts, streams, vaults  # noqa: F401  (fill the registry)
from martworks.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
