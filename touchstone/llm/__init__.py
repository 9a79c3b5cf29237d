"""Operators for building training data: search, mixing, scoring, dedup, filtering, archives.

Nothing else in the library imports this package.
"""
