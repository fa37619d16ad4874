"""Operators wired to tables."""
