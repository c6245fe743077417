"""Structured Streaming ingestion on the batch transforms."""
