"""Readers, writers and the ingest manifest."""
