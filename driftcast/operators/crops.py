"""Crop-area analytics over land parcels.

All are grouped aggregations with map-side partial aggregation; ranking
windows run on the already aggregated (zone, crop) rows, whose size is
bounded by zones × crops. Ties are broken on the crop code so results
are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from driftcast.functions.aggs import n_unique


def commune_parcel_summary(parcels: DataFrame, name: str = "nom_commune") -> DataFrame:
    """Per commune name: total area, distinct parcels, crops, crop groups."""
    return (parcels.groupBy(name).agg(
        F.sum("surf_parc").alias("SAU_tot"),
        n_unique("id_parcel").alias("nb_parc"),
        n_unique("code_cultu").alias("nb_cultures"),
        n_unique("code_group").alias("nb_groupes_culture"))
        .withColumnRenamed(name, "nom_commune"))


def crop_area_by_zone(parcels: DataFrame, zone: list[str]) -> DataFrame:
    """Per (zone, group, crop): total and mean area, parcel count."""
    return parcels.groupBy(*zone, "code_group", "code_cultu").agg(
        F.sum("surf_parc").alias("SAU_tot"),
        F.avg("surf_parc").alias("SAU_moy"),
        F.count(F.lit(1)).alias("nb_parc"))


def zone_summary(parcels: DataFrame, zone: list[str]) -> DataFrame:
    """Per zone: area, distinct parcels, distinct crops."""
    return parcels.groupBy(*zone).agg(
        F.sum("surf_parc").alias("SAU_tot"),
        n_unique("id_parcel").alias("nb_parc"),
        n_unique("code_cultu").alias("nb_cult"))


def _crop_areas(parcels: DataFrame, zone: list[str]) -> DataFrame:
    return parcels.groupBy(*zone, "code_cultu").agg(F.sum("surf_parc").alias("SAU_cult"))


def majority_crop_by_area(parcels: DataFrame, zone: list[str]) -> DataFrame:
    """Crop with the largest total area per zone (tie: smallest code)."""
    a = _crop_areas(parcels, zone)
    return a.groupBy(*zone).agg(
        F.min_by("code_cultu", F.struct(-F.col("SAU_cult"), F.col("code_cultu"))).alias("cult_maj"))


def majority_crop_by_count(parcels: DataFrame, zone: list[str]) -> DataFrame:
    """Most frequent crop per zone (tie: smallest code)."""
    c = parcels.groupBy(*zone, "code_cultu").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy(*zone).agg(
        F.min_by("code_cultu", F.struct(-F.col("n"), F.col("code_cultu"))).alias("culture_majoritaire"),
        F.max("n").alias("nb_parcelles_culture"))


def ranked_crops(parcels: DataFrame, zone: list[str], zone_total_by: list[str] | None = None,
                 top: int = 3) -> DataFrame:
    """area per crop, share of the zone area (%), ordinal rank (ties
    on the crop code), first ``top`` kept."""
    a = _crop_areas(parcels, zone)
    wz = Window.partitionBy(*(zone_total_by or zone))
    wr = Window.partitionBy(*zone).orderBy(F.col("SAU_cult").desc(), F.col("code_cultu"))
    return (a.withColumn("SAU_tot", F.sum("SAU_cult").over(wz))
             .withColumn("pct_SAU", F.col("SAU_cult") / F.col("SAU_tot") * 100)
             .withColumn("rank", F.row_number().over(wr))
             .where(F.col("rank") <= top))


def top3_crops(parcels: DataFrame, zone: list[str]) -> DataFrame:
    """Zone summary (D7), majority crop (D8) and the top-3 crops as
    ``code_cultu_1 … pct_SAU_3`` (missing ranks are null).

    One aggregate per (zone, crop) gives areas, total, crop count and ranks;
    only the distinct parcels read the table again. Everything is keyed on
    the whole zone (code and name): the reference ranks and pivots per name,
    which mixes communes of the same name."""
    crops = (_crop_areas(parcels, zone).groupBy(*zone).agg(
        F.sum("SAU_cult").alias("SAU_tot"), F.count(F.lit(1)).alias("nb_cult"),
        F.array_sort(F.collect_list(F.struct((-F.col("SAU_cult")).alias("neg"), "code_cultu"))).alias("_top")))
    places = []
    for k in (1, 2, 3):
        entry = F.get("_top", F.lit(k - 1))
        places += [entry["code_cultu"].alias(f"code_cultu_{k}"), (-entry["neg"]).alias(f"SAU_cult_{k}"),
                   (-entry["neg"] / F.col("SAU_tot") * 100).alias(f"pct_SAU_{k}")]
    count = parcels.groupBy(*zone).agg(n_unique("id_parcel").alias("nb_parc"))
    return count.join(crops, zone).select(
        *zone, "SAU_tot", "nb_parc", "nb_cult", F.get("_top", F.lit(0))["code_cultu"].alias("cult_maj"), *places)


def _pivot_name(c: str) -> str:
    # Spark names pivot columns "<value>_<alias>"; the reference "<alias>_<value>"
    head, sep, tail = c.partition("_")
    return f"{tail}_{head}" if sep and head.isdigit() else c


def communes_with_epci(epci: DataFrame, communes: DataFrame) -> DataFrame:
    """EPCI left join communes on the EPCI code carried by communes."""
    e = epci.select(F.col("nom_officiel").alias("nom_epci"), "nature", "code_siren")
    c = communes.select("nom_commune", "code_insee", "code_postal", "codes_siren_des_epci")
    return e.join(c, e.code_siren == c.codes_siren_des_epci, "left")


def ift_with_epci(ift: DataFrame, cwe: DataFrame) -> DataFrame:
    """IFT left join the commune–EPCI table."""
    return ift.join(cwe, ift.insee_com == cwe.code_insee, "left")


def epci_summary(iwe: DataFrame) -> DataFrame:
    """Per EPCI: distinct postcodes and communes, area sums, IFT means."""
    return iwe.groupBy("codes_siren_des_epci", "nom_epci").agg(
        n_unique("code_postal").alias("nb_code_postal"),
        n_unique("insee_com").alias("nb_communes"),
        F.sum("sau").alias("SAU_tot"),
        F.sum("sau_bio").alias("SAU_bio_tot"),
        F.avg("ift_t_hbc").alias("ift_t_hbc_moy"),
        F.avg("ift_hh_hbc").alias("ift_hh_hbc_moy"),
        F.avg("ift_h").alias("ift_h_moy"))


def epci_cardinality_check(cwe: DataFrame) -> DataFrame:
    """Distinct names, postcodes, communes, ids per EPCI link (pandas
    ``nunique``: nulls not counted)."""
    return cwe.groupBy("codes_siren_des_epci").agg(
        F.count_distinct("nom_epci").alias("nb_nom_epci"),
        F.count_distinct("code_postal").alias("nb_code_postal"),
        F.count_distinct("code_insee").alias("nb_communes"),
        F.count_distinct("code_siren").alias("nb_epci"))


def epci_top3_crops(iwe: DataFrame) -> DataFrame:
    """Area proxy (sum of commune SAU) per (EPCI, majority crop) and
    commune count, ordinal rank, top 3 pivoted to c_maj_1 … sau_c_maj_3."""
    g = iwe.groupBy("codes_siren_des_epci", "nom_epci", "c_maj", "cod_c_maj").agg(
        F.sum("sau").alias("proxy_sau_culture"), F.count("insee_com").alias("nb_communes"))
    w = Window.partitionBy("codes_siren_des_epci").orderBy(
        F.col("proxy_sau_culture").desc(), F.col("cod_c_maj"), F.col("c_maj"))
    r = g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= 3)
    piv = (r.groupBy("codes_siren_des_epci", "nom_epci").pivot("rank", [1, 2, 3])
             .agg(F.first("c_maj").alias("c_maj"), F.first("cod_c_maj").alias("cod_c_maj"),
                  F.first("proxy_sau_culture").alias("sau_c_maj")))
    return piv.toDF(*[_pivot_name(c) for c in piv.columns])


def ift_right_rpg(ift: DataFrame, rpg_zone: DataFrame, code_ift: str = "insee_com",
                  code_rpg: str = "code_insee") -> DataFrame:
    """IFT right outer join the parcel summary; match flag of the
    majority crop codes (null when either side is null)."""
    j = ift.join(rpg_zone, ift[code_ift] == rpg_zone[code_rpg], "right")
    return j.withColumn("match_code_majoritaire", F.col("code_cultu_1") == F.col("cod_c_maj"))


def match_metrics(cmp: DataFrame, culture_ift: str = "cod_c_maj") -> DataFrame:
    """Totals, non-null counts, matches, match rate (nulls ignored),
    distinct codes on both sides (null counted as a value)."""
    m = F.col("match_code_majoritaire")
    return cmp.agg(
        F.count(F.lit(1)).alias("total"),
        F.count("code_cultu_1").alias("avec_rpg"),
        F.coalesce(F.sum(m.cast("int")), F.lit(0)).cast("bigint").alias("nb_match"),
        F.avg(m.cast("double")).alias("taux_match"),
        F.count(culture_ift).alias("avec_ift"),
        n_unique(culture_ift).alias("nb_codes_ift"),
        n_unique("code_cultu_1").alias("nb_codes_rpg"))


def crosstab_long(cmp: DataFrame, a: str = "cod_c_maj", b: str = "code_cultu_1") -> DataFrame:
    """Contingency counts and row percentages, long form (rows with a
    register crop only)."""
    c = (cmp.where(F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))
    return c.withColumn("pct_ligne", F.col("n") / F.sum("n").over(Window.partitionBy(a)) * 100)


def crop_label_join(cmp: DataFrame, nomenclature: DataFrame) -> DataFrame:
    """C14: label of the register's first crop."""
    lab = nomenclature.select(F.col("code_culture").alias("code_cultu_1"),
                              F.col("libelle_culture").alias("lib_cultu_1"))
    return cmp.join(lab, "code_cultu_1", "left")


def divergences(labelled: DataFrame, zone_col: str = "nom_commune",
                culture_ift: str = "cod_c_maj") -> DataFrame:
    """Rows whose codes differ while a register crop exists."""
    return (labelled.where((F.col("match_code_majoritaire") == F.lit(False))
                           & F.col("code_cultu_1").isNotNull())
                    .select(zone_col, culture_ift, "code_cultu_1", "lib_cultu_1"))


def match_rate_by_crop(cmp: DataFrame, top: int = 30) -> DataFrame:
    """Communes and match rate per IFT crop, rate rounded to 2,
    the ``top`` crops with most communes (tie: code)."""
    g = (cmp.where(F.col("code_cultu_1").isNotNull()).groupBy("cod_c_maj", "c_maj").agg(
        F.count(F.lit(1)).alias("nb_communes"),
        F.round(F.avg(F.col("match_code_majoritaire").cast("double")), 2).alias("taux_match")))
    return g.orderBy(F.col("nb_communes").desc(), "cod_c_maj", "c_maj").limit(top)


def admin_hierarchy(communes: DataFrame, deps: DataFrame, regions: DataFrame) -> DataFrame:
    """C11: departement -> region, commune -> departement (inner joins)."""
    d = deps.select("code_insee_dep", "nom_dep", "code_insee_reg").join(
        regions.select("code_insee_reg", "nom_reg"), "code_insee_reg", "inner")
    return communes.join(d, "code_insee_dep", "inner")


def area_check(parcels: DataFrame, zone: list[str]) -> DataFrame:
    """The zone total computed twice (summing parcels, and summing the
    per-crop totals of D6) agree after rounding to 3, for every zone."""
    a = zone_summary(parcels, zone).select(*zone, F.round("SAU_tot", 3).alias("a"))
    b = (crop_area_by_zone(parcels, zone).groupBy(*zone)
         .agg(F.round(F.sum("SAU_tot"), 3).alias("b")))
    j = a.join(b, zone, "inner")
    return j.agg(F.bool_and(F.col("a") == F.col("b")).alias("all_equal"),
                 F.count(F.lit(1)).alias("nb_zones"))


def zone_totals(parcels: DataFrame, zone: list[str], key_value: str) -> DataFrame:
    """Parcels and area of one zone summed over its crops, beside D7."""
    k = zone[0]
    per_crop = crop_area_by_zone(parcels.where(F.col(k) == F.lit(key_value)), zone)
    s = per_crop.groupBy(*zone).agg(F.sum("nb_parc").alias("nb_parc_crops"),
                                    F.sum("SAU_tot").alias("SAU_tot_crops"))
    return s.join(zone_summary(parcels.where(F.col(k) == F.lit(key_value)), zone), zone)


def commune_parcel_stats(parcels: DataFrame, zone: list[str], bio_group: str = "BIO") -> DataFrame:
    """Parcels, distinct crops, total area, % of parcels in group BIO."""
    return parcels.groupBy(*zone).agg(
        F.count(F.lit(1)).alias("nb_parcelles"),
        F.count_distinct("code_cultu").alias("nb_cultures"),
        F.sum("surf_parc").alias("surface_totale"),
        (F.avg((F.col("code_group") == F.lit(bio_group)).cast("double")) * 100).alias("pct_bio"))
