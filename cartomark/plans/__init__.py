"""Evaluation jobs composed from the operators."""
