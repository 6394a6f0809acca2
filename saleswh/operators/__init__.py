"""Relational building blocks (windows, merges, DQ, joins, aggregates)."""
