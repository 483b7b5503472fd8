"""Readers, writers and row layouts."""
