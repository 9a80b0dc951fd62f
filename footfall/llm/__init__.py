"""Operators of a training-data pipeline: search, scoring, tokens, packing, dedup, sharding."""
