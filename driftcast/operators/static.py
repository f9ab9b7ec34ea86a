"""Static reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftcast.functions.columns import dep_of_insee

# FIXED VALUES — the 19 IFT columns kept from the source file
IFT_COLUMNS = ("id", "insee_com", "sau", "sau_bio", "p_bio", "p_bc", "p_sau", "c_maj", "c_ift_hbc",
               "c_ift_h", "cod_c_maj", "cod_c_hbc", "cod_c_h", "ift_t", "ift_t_hbc", "ift_h",
               "ift_t_hh", "ift_hh_hbc", "iftbc")


def dedupe_keep_first(df: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """One row per ``key``, the first in file order (``order``); plus a
    one-row table with the number of dropped rows.

    ``min_by(struct(row), order)`` is an aggregate with map-side partial
    aggregation: even a key holding a third of the rows is reduced to one
    row per task before the shuffle (``dropDuplicates`` alone would keep an
    arbitrary row)."""
    cols = [c for c in df.columns if c != key]
    g = df.groupBy(key).agg(F.min_by(F.struct(*cols), F.col(order)).alias("_r"),
                            F.count(F.lit(1)).alias("_n"))
    kept = g.select(key, "_r.*").select(*df.columns)
    dropped = g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("doublons_supprimes"))
    return kept, dropped


def code_labels(nomenclature: DataFrame, order: str | None = None) -> DataFrame:
    """Code -> label with dict semantics (the last row of a code wins)."""
    if order is None:
        return nomenclature.groupBy("code_culture").agg(F.max("libelle_culture").alias("libelle_culture"))
    return nomenclature.groupBy("code_culture").agg(
        F.max_by("libelle_culture", F.col(order)).alias("libelle_culture"))


def build_ift(raw: DataFrame, nomenclature: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The 19 columns, first row per commune (D31), labels of the three
    crop codes (three joins on the code table), departement = first two characters (B4)."""
    ift, dropped = dedupe_keep_first(raw.select(*IFT_COLUMNS), "insee_com", "id")
    lab = code_labels(nomenclature)
    for src, dst in (("cod_c_maj", "c_maj_depuis_code"), ("cod_c_hbc", "c_ift_hbc_depuis_code"),
                     ("cod_c_h", "c_ift_h_depuis_code")):
        l2 = lab.select(F.col("code_culture").alias(f"_k_{dst}"), F.col("libelle_culture").alias(dst))
        ift = ift.join(l2, ift[src] == l2[f"_k_{dst}"], "left").drop(f"_k_{dst}")
    return ift.withColumn("code_insee_dep", dep_of_insee("insee_com")), dropped


def enrich_ift(ift: DataFrame, communes: DataFrame) -> DataFrame:
    """Left join on the commune code; the communes' departement comes in
    as ``code_insee_dep_right``."""
    c = communes.select(F.col("code_insee").alias("_code"), "nom_commune",
                        F.col("code_insee_dep").alias("code_insee_dep_right"),
                        "code_insee_reg", "longitude", "latitude")
    return ift.join(c, ift.insee_com == c._code, "left").drop("_code")


def build_static(spark, out: str, raw_ift: DataFrame, nomenclature: DataFrame, communes: DataFrame,
                 calendar: DataFrame) -> dict[str, str]:
    """Write communes, IFT, enriched IFT, calendar and nomenclature
    tables under ``out`` (shared storage); returns their paths."""
    ift, _ = build_ift(raw_ift, nomenclature)
    tables = {"communes_admin": communes, "ift_communes": ift,
              "ift_communes_enrichi": enrich_ift(ift, communes),
              "calendrier_epandage": calendar, "nomenclature_annexe_a": nomenclature}
    paths = {}
    for name, df in tables.items():
        p = f"{out.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


def build_static_from_sources(spark, out: str, outlines: DataFrame, raw_ift: DataFrame, annexes: dict[str, DataFrame],
                              sheet: DataFrame, annee: int, idf: DataFrame | None = None,
                              parcels: DataFrame | None = None) -> dict[str, str]:
    """A17 end to end: commune outlines (code_insee, nom_commune,
    code_insee_dep, code_insee_reg, ring) → centroids → communes; raw IFT and
    annexe "a" → IFT tables; the calendar sheet (and the Île-de-France table)
    → calendar of ``annee`` (E13); all annexes; and, when parcels are given,
    the per-commune details (D5 after C16)."""
    from driftcast.operators.calendar import build_calendar
    from driftcast.operators.crops import commune_parcel_summary
    from driftcast.operators.geo import centroids_wgs84, parcels_within
    points = centroids_wgs84(outlines, "code_insee").select("code_insee", "longitude", "latitude")
    communes = outlines.drop("ring").join(points, "code_insee", "left")
    paths = build_static(spark, out, raw_ift, annexes["a"], communes, build_calendar(sheet, annee, idf))
    more = {f"nomenclature_annexe_{k}": df for k, df in annexes.items() if k != "a"}
    if parcels is not None:
        more["communes_details"] = commune_parcel_summary(parcels_within(
            parcels, outlines, ["nom_commune"], "left", keep=["id_parcel", "code_cultu", "code_group", "surf_parc"]))
    for name, df in more.items():
        paths[name] = f"{out.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    return paths
