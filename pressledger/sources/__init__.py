"""Readers of raw input and published tables."""
