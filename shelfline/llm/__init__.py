"""Operators of a training-data pipeline: extraction, joins, tokens, deduplication, scoring and rules."""
