"""Training-data operators: encoding, audit, deduplication, scoring and quality rules."""
