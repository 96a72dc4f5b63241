"""Operators of a training-data pipeline: deduplication, archives, fingerprints, filters, scoring, packing, mixing."""
