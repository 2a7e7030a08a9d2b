"""Operators of a training-data pipeline: quality, tokens, dedup, mixing, packing, secrets."""
