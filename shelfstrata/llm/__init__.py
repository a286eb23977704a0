"""Operators of a training-data pipeline: deduplication, scoring, scanning, mixing, archives, extraction."""
