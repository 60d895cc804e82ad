"""Structured Streaming versions of the operators whose input keeps arriving."""
