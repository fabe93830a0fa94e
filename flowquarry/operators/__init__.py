"""Relational operators: enrichment, deduplication, temporal joins, rollups."""
