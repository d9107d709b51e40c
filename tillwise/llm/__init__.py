"""Operators for training-data pipelines: deduplication, filtering, scoring, mixing and token output.

Nothing else in the library imports this package.
"""
