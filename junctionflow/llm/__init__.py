"""Operators for training-data corpora: deduplication, quality, toxicity, packing, sharding, tokenising, fingerprints."""
