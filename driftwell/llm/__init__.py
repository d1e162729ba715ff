"""Training-data operators: filtering, deduplication, packing and search."""
