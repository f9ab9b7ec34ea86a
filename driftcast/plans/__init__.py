"""Named queries over the fixture views, each with its DuckDB oracle.

``registry()`` returns {name: (spark_fn(spark, sf_dir) -> DataFrame,
oracle_sql or None)}; ``__spark_entry__`` only wires it.
"""
