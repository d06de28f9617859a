"""Operators: data-quality rules, rolling metrics, star-schema building, measures, join helpers."""
