"""Operators for training-data pipelines: de-duplication, filtering, tokenising, packing and sharding of documents."""
