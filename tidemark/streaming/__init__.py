"""Structured Streaming runners for the clean and report pipelines."""
