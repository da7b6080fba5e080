"""Readers for raw files and request batches, writers for mart tables."""
