"""Aggregate helpers with the reference's counting semantics."""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def n_unique(c: str) -> Column:
    """Distinct values counting null as one value (the Polars ``n_unique``)."""
    col = F.col(c)
    return (F.count_distinct(col)
            + F.max(F.when(col.isNull(), F.lit(1)).otherwise(F.lit(0)))).cast("bigint")


def n_unique_sql(c: str) -> str:
    return f"CAST(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT)"


def ordered_sum(c: str) -> Column:
    """Sum of a bounded group (e.g. the days of one commune-year) added in
    ascending order, so the double result does not depend on how rows were
    split over tasks. Nulls are skipped, an empty group sums to 0."""
    return F.aggregate(F.array_sort(F.collect_list(F.col(c))), F.lit(0.0), lambda a, v: a + v)


def ordered_sum_sql(c: str) -> str:
    return (f"coalesce(list_reduce(list_sort(list({c}) FILTER (WHERE {c} IS NOT NULL)), "
            f"lambda a, v: a + v), 0)")


def exact_percentiles(df, col: str, probs, keys: list[str] | None = None):
    """Exact percentiles (linear interpolation) of ``col``, per ``keys``;
    returns ``keys`` and ``p`` (array).

    Rows are counted per distinct value (map-side combined) and the pairs are
    range-partitioned by (keys, value) into the shared folder. The pairs
    before each part of a key come from the parts' totals (one row per key
    and part), so every part numbers its own values and the two values
    around each position are picked by a partial aggregate: no key, and no
    single task, holds all values."""
    from driftcast.session import shared_path
    keys = keys or []
    spark = df.sparkSession
    pairs = df.where(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"))
    path = shared_path(spark, "percentiles")
    (pairs.repartitionByRange(*keys, "_v").withColumn("_part", F.spark_partition_id()).write.parquet(path))
    ranged = spark.read.schema(T.StructType([*pairs.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(path)
    totals = ranged.groupBy(*keys, "_part").agg(F.sum("_n").alias("_t"))
    by_key = Window.partitionBy(*[F.col(k) for k in keys]) if keys else Window.partitionBy(F.lit(0))
    parts = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_part").alias("_p"),
                          F.sum("_t").over(by_key).alias("_all"),
                          (F.sum("_t").over(by_key.orderBy("_part")) - F.col("_t")).alias("_before"))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    upto = F.sum("_n").over(Window.partitionBy(*keys, "_part").orderBy("_v"))
    ranked = ranged.join(parts, same).select(*keys, "_v", "_all", (F.col("_before") + upto).alias("_upto"))
    picks = []
    for i, p in enumerate(probs):
        place = (F.col("_all") - 1) * F.lit(float(p))
        for name, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            picks.append(F.min(F.when(F.col("_upto") > at, F.col("_v"))).cast("double").alias(f"_{name}{i}"))
    picked = ranked.groupBy(*keys).agg(*picks, F.max("_all").alias("_all"))
    out = []
    for i, p in enumerate(probs):
        place, lo, hi = (F.col("_all") - 1) * F.lit(float(p)), F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(place) - place) * lo + (place - F.floor(place)) * hi))
    return picked.select(*keys, F.when(F.col("_all").isNotNull(), F.array(*out)).alias("p"))
