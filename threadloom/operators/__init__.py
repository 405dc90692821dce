"""Relational operators: graph closure, windows, joins, aggregates, gates."""
