"""Spark jobs that turn free-text interviews into labelled, audited cases."""
