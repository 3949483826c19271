"""Operators for large text corpora (quality, deduplication, scoring, mixing, sharding).

Nothing outside this subpackage imports it.
"""
