"""Relational, graph and temporal operators; each maps DataFrames to a DataFrame."""
