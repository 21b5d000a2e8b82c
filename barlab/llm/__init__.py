"""Training-data operators: filtering, extraction, deduplication, search, mixing and packing."""
