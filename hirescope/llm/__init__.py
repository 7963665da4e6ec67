"""Training-data operators: deduplication, scoring, extraction, packing."""
