"""Queries over the reference tables and their oracle SQL, gathered from the modules of this package."""

from __future__ import annotations

from terrane.plans import q_aggregates, q_cells, q_contributions, q_files, q_geometry, q_joins, q_rows, q_streams

FLAGSHIP = "m7_summarise_by_place"
QUERIES: dict = {}
ORACLE_SQL: dict = {}
for module in (q_rows, q_joins, q_aggregates, q_geometry, q_cells, q_contributions, q_files, q_streams):
    QUERIES |= module.QUERIES
    ORACLE_SQL |= module.ORACLE_SQL
