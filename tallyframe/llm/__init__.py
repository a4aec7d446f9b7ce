"""Operators for preparing training text: deduplication, quality, decontamination, privacy, mixing, sharding."""
