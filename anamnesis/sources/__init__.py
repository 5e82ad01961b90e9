"""Readers and writers: text files, tables, versioned artifacts."""
