"""Training-data operators: deduplication, token output, mixing, quality
models, search and language identification for large text corpora."""
