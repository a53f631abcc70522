"""Operators for preparing training data: filters, deduplication, mixing, packing.

Nothing else in the library imports this subpackage; ``queries.py`` and ``oracles.py`` hold its
queries and their SQL twins.
"""
