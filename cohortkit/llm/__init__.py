"""Operators for preparing training text: deduplication, filtering, scoring, packing, formatting and search."""
