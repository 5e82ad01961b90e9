"""Structured Streaming forms of the on-demand and metrics jobs."""
