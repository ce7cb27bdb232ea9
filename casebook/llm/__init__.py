"""Corpus operators: archives, deduplication, decontamination, quality, mixing and sharding."""
