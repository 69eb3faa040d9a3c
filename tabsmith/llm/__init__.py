"""Operators of a training-data pipeline (packing, search, deduplication,
extraction, classifiers). Nothing else in the library imports this package."""
