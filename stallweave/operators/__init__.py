"""Reusable DataFrame operators: predicates, deduplication, joins, ranking, trees, encoding, vector search."""
