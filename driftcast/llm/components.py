"""Connected components by hooking and contraction, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftcast.llm.common import staged


def connected(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of the edges (a, b: long).

    Each round every vertex points to its least neighbour if that is less than
    itself, and the graph is contracted along the pointers; with ids in random
    order (as the callers' keys are) the edges shrink geometrically. Rounds are
    written to the shared folder; a hot vertex is pre-aggregated.
    """
    spark = edges.sparkSession
    left = staged(spark, edges.filter("a <> b").select("a", "b").distinct(), "cc-edges")
    pointers = []
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = staged(spark, both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("b"))
                      .select("v", F.least("v", "b").alias("parent")), "cc-hook")
        pointers.append(hook)
        left = staged(spark, left.join(hook.select(F.col("v").alias("a"), F.col("parent").alias("pa")), "a")
                      .join(hook.select(F.col("v").alias("b"), F.col("parent").alias("pb")), "b")
                      .filter("pa <> pb").select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct(), "cc-edges")
    if not pointers:
        return spark.createDataFrame([], "v bigint, root bigint")
    root = pointers[-1].select("v", F.col("parent").alias("root"))
    for hook in reversed(pointers[:-1]):
        after = root.select(F.col("v").alias("parent"), "root")
        root = hook.join(after, "parent", "left").select("v", F.coalesce("root", "parent").alias("root"))
    return staged(spark, root, "cc-roots")
