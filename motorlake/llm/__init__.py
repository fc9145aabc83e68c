"""Training-data operators: formatting, search, deduplication, classification, mixing, packing, counting."""
