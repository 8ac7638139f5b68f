"""Training-data operators: deduplication, scoring, extraction, fingerprints and packing.

Nothing else in the library imports this subpackage.
"""
