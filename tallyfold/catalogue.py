"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from .queries import analytics, reconcile  # noqa: F401  (they register themselves)
from .queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
