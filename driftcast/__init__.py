"""driftcast — daily pesticide-exposure analytics per commune, on Spark.

Every operator is a DataFrame / Spark SQL expression over whole tables;
``driftcast.plans.registry`` wires them into named queries with DuckDB
oracles over the fixture views (FIXTURES.md).
"""

__all__ = ["session", "config", "fixtures"]
