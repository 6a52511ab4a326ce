"""Structured Streaming ingestion."""
