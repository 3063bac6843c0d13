"""Incremental arrival of files."""
