"""Training-data operators: packing, sharding, language, deduplication, extraction, quality."""
