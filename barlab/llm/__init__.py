"""Operators on text corpora: scans, filters, deduplication and token output."""
