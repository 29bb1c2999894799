"""Operators put together: feature table, training, inference."""
