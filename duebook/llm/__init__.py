"""Operators and queries that prepare training data for language models."""
