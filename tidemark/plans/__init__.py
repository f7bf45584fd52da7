"""Whole flows: news lakehouse, retail dimensions and governance."""
