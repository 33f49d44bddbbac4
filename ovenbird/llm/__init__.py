"""Operators of a training-data pipeline (scans, dedup, packing, formatting)."""
