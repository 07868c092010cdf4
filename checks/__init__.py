"""Projections of the given tables to the domain, queries over them, and their SQL twins."""
