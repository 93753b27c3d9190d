"""Relational operators: projections, windows, joins, aggregates, merges, flattening."""
