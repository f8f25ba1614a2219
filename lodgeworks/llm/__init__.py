"""Operators of a training-data pipeline: mixing, quality, filters, shards, archives, duplicates, ids, search."""
