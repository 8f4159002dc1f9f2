"""Operators of a training-data pipeline: mixing, near and exact duplicates, filters, scores, pieces.

Nothing else in the library imports this package.
"""
