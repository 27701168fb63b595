"""Scoring and data quality on streams."""
