"""The engine's named queries over the test tables, each with its SQL."""

from __future__ import annotations

from lodestrata.plans import evidence, knowledge, records, times
from lodestrata.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES", "evidence", "knowledge", "records", "times"]
