"""Operators over text corpora: deduplication, filtering, extraction, tokens and packing."""
