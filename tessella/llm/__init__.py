"""Operators for training-data pipelines: scoring, filters, deduplication, mixing, token output."""
