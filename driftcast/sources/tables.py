"""Readers, writers and table maintenance.

Writes go to the shared folder (``spark.checkpoint.dir`` of the cluster).
Tables that are updated in part (risk, weather history) are versioned
(``sources.versions``): an update writes new files and swaps the version last.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.operators.risk import check_region
from driftcast.session import shared_path
from driftcast.sources import versions

log = logging.getLogger(__name__)

COMMUNES_SCHEMA = T.StructType([
    T.StructField("code_insee", T.StringType()), T.StructField("nom_commune", T.StringType()),
    T.StructField("code_insee_dep", T.StringType()), T.StructField("code_insee_reg", T.StringType()),
    T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType()),
])

RISK_SCHEMA = T.StructType([
    T.StructField("insee_com", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("ift_journalier_total", T.DoubleType()), T.StructField("indicateur_meteo", T.IntegerType()),
    T.StructField("interdiction_pulv", T.BooleanType()), T.StructField("traitement_deconseille", T.BooleanType()),
    T.StructField("pluie_limitante", T.BooleanType()), T.StructField("risque_dispersion", T.BooleanType()),
    T.StructField("wind_speed_10m_mean", T.DoubleType()), T.StructField("precipitation_sum", T.DoubleType()),
    T.StructField("risque_brut", T.DoubleType()), T.StructField("risque_0_4", T.IntegerType()),
])


# stored risk table: the risk columns + partition columns (codes stay text)
RISK_TABLE_SCHEMA = T.StructType(RISK_SCHEMA.fields + [
    T.StructField("annee", T.IntegerType()), T.StructField("dep", T.StringType())])


def load_communes(communes: DataFrame, region: str | None = None, check_empty: bool = True) -> DataFrame:
    """A1: optional region filter (pushed to the scan); an unknown region
    names the valid ones; an empty result is an error (one-row probe)."""
    code = check_region(region)
    df = communes if code is None else communes.where(F.col("code_insee_reg") == F.lit(code))
    if check_empty and df.isEmpty():
        raise ValueError(f"No commune found for region '{region}'.")
    return df


def read_communes(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """A1 on a stored table: explicit schema, filter pushed to Parquet."""
    return load_communes(spark.read.schema(COMMUNES_SCHEMA).parquet(path), region)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ";") -> DataFrame:
    """A2: delimited text with a header; the key columns typed by the schema
    (commune codes stay text)."""
    return spark.read.option("header", True).option("sep", sep).schema(schema).csv(path)


def read_sheet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A3: one landed sheet (Parquet with the sheet headers)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def read_partitioned(spark: SparkSession, path: str, hive: bool = True) -> DataFrame:
    """A4: recursive read of a directory. ``hive=True``: ``k=v`` folders
    become columns (partition discovery); ``hive=False``: plain folders
    (e.g. ``historique/2024/``) read with ``recursiveFileLookup``."""
    if hive:
        return spark.read.parquet(path)
    return spark.read.option("recursiveFileLookup", "true").parquet(path)


YEAR_PATH = r"indicateurs_meteo_(\d{4})\.parquet(/|$)"


def union_years(spark: SparkSession, folder: str) -> DataFrame:
    """A5/H2: every ``indicateurs_meteo_YYYY`` file or folder (exactly four
    digits, by the glob itself), one read, the year taken from the path —
    no loop of unions."""
    df = spark.read.parquet(f"{folder.rstrip('/')}/indicateurs_meteo_[0-9][0-9][0-9][0-9].parquet")
    return df.withColumn("annee", F.regexp_extract(F.col("_metadata.file_path"), YEAR_PATH, 1).cast("int"))


def union_forecasts(spark: SparkSession, folder: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Union all of the forecast files of every region (one read of
    the ``indicateurs_previsions*`` glob). Pass a schema when a partition
    column holds codes: inference would turn "01" into 1."""
    r = spark.read if schema is None else spark.read.schema(schema)
    return r.parquet(f"{folder.rstrip('/')}/indicateurs_previsions*")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (globs allowed) names something, asked of the file
    system itself; a file system that fails raises."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a table was written to its end (its job left ``_SUCCESS``)."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def register_views(spark: SparkSession, paths: dict[str, str], weather_enabled: bool = True,
                   weather_views: tuple[str, ...] = ("meteo_historique", "meteo_previsions")) -> DataFrame:
    """One temp view per existing path; a missing path is skipped with a
    warning, anything else that fails raises. The raw weather views are left
    out when weather is switched off. Returns (view, registered) rows."""
    rows = []
    for name, path in paths.items():
        if not weather_enabled and name in weather_views:
            continue
        there = path_exists(spark, path)
        if there:
            spark.read.parquet(path).createOrReplaceTempView(name)
        else:
            log.warning("missing file, view skipped: %s", path)
        rows.append((name, there))
    return spark.createDataFrame(rows, "view string, registered boolean")


def table_counts(spark: SparkSession, views: list[str]) -> DataFrame:
    """Row count of every view in one job (union of per-view counts); a
    view that does not exist is reported with a null count."""
    parts = []
    for v in views:
        if spark.catalog.tableExists(v):
            parts.append(spark.table(v).select(F.lit(v).alias("view"), F.count(F.lit(1)).alias("rows")))
        else:
            parts.append(spark.range(1).select(F.lit(v).alias("view"), F.lit(None).cast("bigint").alias("rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def master_view(ift_enrichi: DataFrame, communes: DataFrame) -> DataFrame:
    """Enriched IFT left join communes, 17 columns; the second copies of
    ``c_maj`` and ``nom_commune`` get explicit names."""
    i, c = ift_enrichi.alias("i"), communes.alias("c")
    return i.join(c, F.col("i.insee_com") == F.col("c.code_insee"), "left").select(
        "i.insee_com", "i.nom_commune", "i.c_maj", "i.c_ift_hbc", "i.c_ift_h",
        F.col("i.c_maj").alias("c_maj_2"), "i.ift_t", "i.ift_t_hbc", "i.ift_h", "i.iftbc", "i.p_bio",
        "i.p_sau", F.col("c.nom_commune").alias("nom_commune_2"), "c.code_insee_dep", "c.code_insee_reg",
        "c.latitude", "c.longitude")


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key violations (keys with more than one row)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


RISK_PARTITIONS, RISK_ORDER = ["annee", "dep"], ["insee_com", "date"]


def upsert_year(spark: SparkSession, table: str, new: DataFrame, annee: int,
                key: str | list[str] = "insee_com") -> None:
    """Replace the rows of ``annee`` for the communes present in
    ``new``, keep the others (partial update by region). With
    ``key=["insee_com", "date"]`` only the recomputed (commune, day) rows are
    replaced (J2).

    The table is versioned and partitioned by (annee, dep) — ``dep`` = first
    two characters of the commune code. ``new`` is computed and written once,
    as part of the next version; the rows it does not replace, of the
    departements it touches only, are read from the old version and written
    beside it; then the version is swapped. Whatever fails before, the old
    version stays. A missing table is created; a column that only one side
    has stays, null in the other's rows.
    """
    versions.commit(spark, table, prepare_year(spark, table, new, annee, key))


def prepare_year(spark: SparkSession, table: str, new: DataFrame, annee: int,
                 key: str | list[str] = "insee_com") -> versions.Version:
    """All writes of ``upsert_year``: the version that ``versions.commit``
    makes the table's next."""
    keys = [key] if isinstance(key, str) else list(key)
    # not the plain literal: the planner would drop it from the sort order,
    # find the partition order unmet and replace the sort by its own
    year = F.coalesce(F.year("date"), F.lit(annee))
    new = new.withColumns({"annee": year, "dep": F.substring("insee_com", 1, 2)})
    new.select(*keys)  # an unknown key raises here
    base = versions.current(spark, table)
    fresh = versions.write(spark, new, table, RISK_PARTITIONS, RISK_ORDER)
    parts = {p: (fresh.id,) for p in fresh.parts}
    touched = [p for p in fresh.parts if base and p in base.parts]
    if touched:
        mine = versions.read_written(spark, table, fresh).select(*keys).distinct()
        old = versions.read(spark, table, base, touched)
        if "date" in keys:
            # days without a new row are kept as they are, without a join;
            # at most a year's days, read off the written files
            days = [r["date"] for r in mine.select("date").distinct().collect() if r["date"] is not None]
            met = F.coalesce(F.col("date").isin(days), F.lit(False))
            keep = old.where(~met).unionByName(old.where(met).join(mine, keys, "left_anti").select(*old.columns))
        else:
            keep = old.join(mine, keys, "left_anti")
        kept = versions.write(spark, keep, table, RISK_PARTITIONS, RISK_ORDER)
        parts |= {p: (fresh.id, kept.id) for p in kept.parts}
    return versions.successor(base, RISK_PARTITIONS, new.schema, parts)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read back."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_risk(spark: SparkSession, table: str) -> DataFrame:
    """The stored risk table (its newest version), with ``annee`` and ``dep``."""
    return versions.read(spark, table)


def replace_table(df: DataFrame, path: str) -> None:
    """Drop-and-create semantics (forecasts are not historised)."""
    df.write.mode("overwrite").parquet(path)


def save_weather(df: DataFrame, folder: str, annee: int) -> DataFrame:
    """One folder per year, overwritten; returns rows, first and last day.
    Rebalanced by bytes first, so that what a task sorts does not grow with the
    table when its plan has few tasks."""
    out = f"{folder.rstrip('/')}/historique/{annee}"
    df.hint("rebalance", F.col("code_insee")).sortWithinPartitions("code_insee", "time").write.mode("overwrite").parquet(out)
    return df.sparkSession.read.parquet(out).agg(
        F.count(F.lit(1)).alias("rows"), F.min("time").alias("first_day"), F.max("time").alias("last_day"))


def cached(spark: SparkSession, path: str, compute, force: bool = False) -> DataFrame:
    """Reuse the stored table when it was written to its end (and not
    forced), else compute, store and read it back (which also cuts the
    lineage)."""
    if force or not complete(spark, path):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
