"""Queries over the given tables, each with its SQL counterpart where one exists."""

from __future__ import annotations

from filmlens.registry import basics, encoding, files, grouping, leakage, models, profiles, searches, summaries, temporal, text, validation  # noqa: F401
from filmlens.registry.core import ENTRIES, oracle_sql, queries

__all__ = ["ENTRIES", "oracle_sql", "queries"]
