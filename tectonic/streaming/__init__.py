"""Structured Streaming ingest of newly landed catalogue files."""
