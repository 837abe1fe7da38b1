"""Queries over the synthetic tables."""
