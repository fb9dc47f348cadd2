"""Queries over the given tables, and their reference SQL."""
