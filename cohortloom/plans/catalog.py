"""All registered queries and their SQL."""

from __future__ import annotations

from cohortloom.plans import activity_queries, file_queries, model_queries, sample_queries

_MODULES = [activity_queries, sample_queries, file_queries, model_queries]

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}
