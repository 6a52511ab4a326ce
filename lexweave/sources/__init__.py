"""Readers and parsers for the input forms."""
