"""Training-data operators: deduplication, filtering, classification, mixing, search and formatting."""
