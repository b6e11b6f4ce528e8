"""Operators of a training-data pipeline: cleaning, deduplication, mixing, tokens and output."""
