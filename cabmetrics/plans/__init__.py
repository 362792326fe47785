"""Composed plans: named queries over a data directory and model workflows."""
