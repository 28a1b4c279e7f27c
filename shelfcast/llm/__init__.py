"""Operators for preparing training text: deduplication, filtering, extraction, mixing, search, scoring."""
