"""Training-data operators: deduplication, fingerprints, sharding, packing, filters, token output, mixing."""
