"""Registered queries over the given tables, with their checking SQL."""
