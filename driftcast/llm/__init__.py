"""Operators of a large-scale training-data pipeline, on Spark DataFrames.

Nothing outside this package imports it; ``queries`` holds its registered
queries. Every operator reads documents by column name only, so further
columns (also ones named like an output) never clash.
"""
