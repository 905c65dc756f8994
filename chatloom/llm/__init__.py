"""Operators of a training-data pipeline over whole corpora."""
