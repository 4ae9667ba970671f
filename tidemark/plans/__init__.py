"""Registered queries, one module per family."""

from tidemark.plans import changes, features, governance, quality, relational, reports, storage, streams, texts, windows  # noqa: F401
from tidemark.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
