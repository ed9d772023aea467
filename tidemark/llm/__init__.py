"""Operators of a training-data pipeline: extraction, deduplication, rules, languages, tokens, packing."""
