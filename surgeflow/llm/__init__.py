"""Operators of a large-scale training-data pipeline (see the table in README.md)."""
