"""Training-data operators: scoring, deduplication, archives, mixing and sharding of text tables."""
