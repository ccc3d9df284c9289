"""Operators for training-data pipelines: filters, near-duplicates, archives, tokens, scores."""
