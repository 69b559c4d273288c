"""Operators for preparing training data: search, deduplication, tokens, packing, scans and classifiers."""
