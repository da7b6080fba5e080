"""Structured Streaming scoring of request files."""
