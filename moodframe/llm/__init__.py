"""Operators for preparing training text: quality rules, deduplication, personal
data, fingerprints, HTML extraction, chat formatting, mixing and packing.

Nothing else in the library imports this package.
"""
