"""Training-data operators: cleaning, deduplication, formatting and packing of text corpora."""
