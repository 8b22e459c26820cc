"""Operators of a training-data pipeline (deduplication, filters, mixing, search, tokens, archives)."""
