"""Descriptive aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftcast.functions.columns import region_name


def null_census(df: DataFrame) -> DataFrame:
    """Null count of every column, one aggregate pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def describe(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """Count, mean, std (sample), min, exact quartiles (linear), max of
    numeric columns; one row per column (long form, values rounded)."""
    from driftcast.functions.aggs import exact_percentiles
    parts = []
    for c in cols:
        x = F.col(f"`{c}`")
        moments = df.agg(
            F.lit(c).alias("colonne"), F.count(x).alias("count"),
            F.round(F.avg(x), digits).alias("mean"), F.round(F.stddev_samp(x), digits).alias("std"),
            F.min(x).cast("double").alias("min"), F.max(x).cast("double").alias("max"))
        q = exact_percentiles(df.select(x.alias("_x")), "_x", (0.25, 0.5, 0.75)).select("p").scalar()
        parts.append(moments.select("*", *[F.round(q[i], digits).alias(n)
                                           for i, n in enumerate(("q25", "q50", "q75"))]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def crop_catalogue(ift: DataFrame, order: str = "k") -> DataFrame:
    """Distinct crops over the three crop columns with the first
    code found: c_maj first, then c_ift_hbc, then c_ift_h, each in file
    order (``stack`` with a priority, then ``min_by``)."""
    long = ift.select(order, F.expr(
        "stack(3, c_maj, cod_c_maj, 1, c_ift_hbc, cod_c_hbc, 2, c_ift_h, cod_c_h, 3) AS (culture, code, prio)"))
    return (long.where(F.col("culture").isNotNull()).groupBy("culture")
                .agg(F.min_by("code", F.struct("prio", order)).alias("code")))


def share_of_days(df: DataFrame, keys: list[str], flags: list[str]) -> DataFrame:
    """Mean of each boolean indicator (nulls ignored)."""
    return df.groupBy(*keys).agg(*[F.avg(F.col(f).cast("double")).alias(f"part_{f}") for f in flags])


def area_quantiles(df: DataFrame, key: str, col: str, min_value: float | None = None) -> DataFrame:
    """Five-number summary (exact percentiles) of ``col`` per ``key``,
    optionally only above ``min_value``."""
    from driftcast.functions.aggs import exact_percentiles
    d = df if min_value is None else df.where(F.col(col) > min_value)
    q = exact_percentiles(d, col, (0.0, 0.25, 0.5, 0.75, 1.0), [key])
    return q.select(key, *[F.col("p")[i].alias(n) for i, n in enumerate(("min", "q25", "q50", "q75", "max"))])


def latest_year_rows(df: DataFrame, year_col: str, order: list[str]) -> DataFrame:
    """Rows of the most recent year (scalar max) with a consecutive
    row id in ``order`` (distributed numbering, no single-partition window)."""
    from driftcast.operators.weather import consecutive_index
    last = df.select(F.max(year_col)).scalar()
    return consecutive_index(df.where(F.col(year_col) == last), order).withColumnRenamed("rn", "row_id")


def region_of_dep(communes: DataFrame, order: str = "code_insee") -> DataFrame:
    """Departement -> region of its first commune in ``order`` (an
    explicit order instead of file order), with the region name
    ("Inconnue" when the code is unknown)."""
    d = communes.groupBy("code_insee_dep").agg(
        F.min_by("code_insee_reg", F.col(order)).alias("code_insee_reg"))
    return d.withColumn("nom_region", region_name("code_insee_reg", "Inconnue"))
