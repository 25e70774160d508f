"""The queries of this subpackage, by name, and the SQL of those that SQL can state."""

from __future__ import annotations

from strandlake.llm.queries import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
