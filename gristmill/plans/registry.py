"""All queries of the library and their SQL."""

from __future__ import annotations

from gristmill.plans import queries, record_queries, vector_queries

__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES = queries.QUERIES | record_queries.QUERIES | vector_queries.QUERIES
ORACLE_SQL = queries.ORACLE_SQL | record_queries.ORACLE_SQL | vector_queries.ORACLE_SQL
