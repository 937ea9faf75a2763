"""Training-data operators: deduplication, scoring, archives, mixing, packing and search."""
