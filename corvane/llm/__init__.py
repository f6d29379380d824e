"""Operators of a training-data pipeline: filters, duplicates, mixing, neighbours, tokens and shards."""
