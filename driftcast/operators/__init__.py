"""Joins, aggregations and the domain operators."""
