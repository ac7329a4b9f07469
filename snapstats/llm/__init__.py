"""Operators of a training-data pipeline: deduplication, quality, tokens, secrets, decontamination."""
