"""Operators of a training-data pipeline (quality, privacy, sharding, mixing,
near-duplicates, tokens).  Nothing else in the library imports this package."""
