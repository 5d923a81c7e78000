"""Registered queries: operators bound to the test tables."""

from tidemark.plans import layout, olap, quality, retail, scans, skew, streams, windows  # noqa: F401
from tidemark.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
