"""All queries of the reference's operators, and their SQL."""

from __future__ import annotations

from strandlake.jobs import annotation, intervals, others, territory, tracks, validation

_MODULES = (intervals, tracks, annotation, territory, others, validation)
QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in _MODULES for name, sql in m.ORACLE.items()}
