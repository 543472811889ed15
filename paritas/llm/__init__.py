"""Operators for large training-data corpora (dedup, scans, formats, packing)."""
