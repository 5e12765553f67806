"""Operators for large text corpora: deduplication, filtering, scoring and encoding."""
