"""Relational operators: windows, joins, aggregates, rules and metrics."""
