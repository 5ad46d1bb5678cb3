"""Registered queries over the testdata tables and their DuckDB oracles, gathered from the plan modules."""

from __future__ import annotations

from quiremill.plans import corpus_queries, table_queries, text_queries

QUERIES = text_queries.QUERIES | table_queries.QUERIES | corpus_queries.QUERIES
ORACLES = text_queries.ORACLES | table_queries.ORACLES | corpus_queries.ORACLES
