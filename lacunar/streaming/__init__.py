"""Filling as new images arrive."""
