"""Operators for training data: quality, duplicates, leaks, mixing, formats and models."""
