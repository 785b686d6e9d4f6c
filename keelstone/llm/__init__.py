"""Training-data operators: deduplication, filtering, sharding, search and tokenising of text corpora."""
