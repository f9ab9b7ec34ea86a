"""Geometry, scalar helpers, descriptive aggregates and set operations
(L1–L4, C16, C17, C19, B1–B22 not covered elsewhere, C18, D2, D3, D25,
D26, D29, D35, D36, D38, G6, H3–H6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftcast.config import MEASURE_RENAME
from driftcast.fixtures import fixture
from driftcast.functions import columns as C
from driftcast.functions.geo import lambert93_sql, rings_within
from driftcast.operators import analytics as AN
from driftcast.operators import geo as G
from driftcast.operators.calendar import (denominators, distinct_active_days, dep_region_bridge, rebase_calendar,
                                          region_active_days, regional_denominators)
from driftcast.operators.display import communes_admin
from driftcast.plans.measures_q import SQL_CLEAN, clean
from driftcast.plans.risk_q import ANNEE, inputs
from driftcast.plans.sqlparts import CROP_MAP_CTE, REGION_CTE
from driftcast.sources.sheets import measurement_sheet

PARCEL_COLS = ["id_parcel", "code_insee_source", "cx", "cy", "half", "code_cultu", "surf_parc"]


def zones(s, sf):
    z = fixture(s, sf, "fx_communes_geo")
    return z.select("code_insee", G.outline_rings("x_l93", "y_l93", "half", F.col("k") % 5).alias("ring"))


def _spread(df):
    """In as many tasks as a shuffle has: the scan of a table of few row groups
    has few, and the work per parcel is large."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "id_parcel")


def parcels(s, sf, spread=_spread):
    """``spread``: not where the parcels are dealt by their place next."""
    p = spread(fixture(s, sf, "fx_parcelles_geo"))
    return p.select(*PARCEL_COLS, G.square_ring("cx", "cy", "half").alias("ring"))


def _within_sql(p: str, g: str) -> str:
    """Square ``p`` within outline ``g`` by its shape (k % 5): bounding box,
    and clear of the notch, the hole or the gap between the parts."""
    west, east = f"{p}.cx + {p}.half <= {g}.x_l93", f"{p}.cx - {p}.half >= {g}.x_l93"
    south, north = f"{p}.cy + {p}.half <= {g}.y_l93", f"{p}.cy - {p}.half >= {g}.y_l93"
    box = (f"{east} - {g}.half AND {west} + {g}.half AND {north} - {g}.half AND {south} + {g}.half")
    return (f"{g}.half > 0 AND {box} AND CASE {g}.k % 5 "
            f"WHEN 2 THEN {west} - {g}.half / 4 OR {east} + {g}.half / 4 OR {south} "
            f"WHEN 3 THEN {west} - {g}.half / 8 OR {east} + {g}.half / 8 OR {south} - {g}.half / 8 OR {north} + {g}.half / 8 "
            f"WHEN 4 THEN {west} - {g}.half / 2 OR {east} ELSE TRUE END")


def as_read(df):
    return df


def parcels_in_parts(s, sf, spread=_spread):
    """Parcels in two parts: their square, and one around the centre of their
    commune's outline as large as its hole (it fills the hole where there is one)."""
    z = fixture(s, sf, "fx_communes_geo").select(F.col("code_insee").alias("code_insee_source"), "x_l93", "y_l93",
                                                  F.col("half").alias("zhalf"))
    p = spread(fixture(s, sf, "fx_parcelles_geo").join(z, "code_insee_source").where("zhalf > 0"))
    return p.select(*PARCEL_COLS, F.array(G.square_ring("cx", "cy", "half"),
                                          G.square_ring("x_l93", "y_l93", F.col("zhalf") / 8)).alias("ring"))


PARTS_CTE = """pp AS (SELECT p.*, g.x_l93 AS b_x, g.y_l93 AS b_y, g.half / 8 AS b_half FROM fx_parcelles_geo p
 JOIN fx_communes_geo g ON g.code_insee = p.code_insee_source WHERE g.half > 0)"""
_BOTH_PARTS = _within_sql("pp", "g") + " AND " + _within_sql("b", "g").replace("b.cx", "pp.b_x").replace(
    "b.cy", "pp.b_y").replace("b.half", "pp.b_half")


_LON, _LAT = lambert93_sql("x_l93", "y_l93")
_PC = ", ".join(f"p.{c}" for c in PARCEL_COLS)

QUERIES = {
    "l1_centroid": (
        lambda s, sf: G.centroids_wgs84(zones(s, sf), "code_insee").select(
            "code_insee", "area", F.round("longitude", 6).alias("longitude"), F.round("latitude", 6).alias("latitude")),
        # area in half², centroid in half of each shape
        f"""WITH g AS (SELECT code_insee, half, x_l93 + half * CASE k % 5 WHEN 4 THEN 1.0 / 12 ELSE 0 END AS x_l93,
  y_l93 + half * CASE k % 5 WHEN 2 THEN -1.0 / 14 ELSE 0 END AS y_l93,
  CASE k % 5 WHEN 2 THEN 3.5 WHEN 3 THEN 3.9375 WHEN 4 THEN 3.0 ELSE 4.0 END AS a FROM fx_communes_geo WHERE half > 0)
SELECT code_insee, CAST(a * half * half AS DOUBLE) AS area, round({_LON}, 6) AS longitude, round({_LAT}, 6) AS latitude FROM g"""),
    "l2_bbox": (
        lambda s, sf: G.with_bbox(zones(s, sf)).drop("ring").where(F.col("xmin").isNotNull()),
        "SELECT code_insee, x_l93 - half AS xmin, y_l93 - half AS ymin, x_l93 + half AS xmax, y_l93 + half AS ymax "
        "FROM fx_communes_geo WHERE half > 0"),
    "l3_within": (
        lambda s, sf: parcels(s, sf).join(zones(s, sf).withColumnRenamed("ring", "zring").withColumnRenamed(
            "code_insee", "code_insee_source"), "code_insee_source").select(
            "id_parcel", rings_within(F.array("ring"), F.col("zring")).alias("within")),
        f"SELECT p.id_parcel, ({_within_sql('p', 'g')}) AS within FROM fx_parcelles_geo p "
        "JOIN fx_communes_geo g ON g.code_insee = p.code_insee_source"),
    "l3_within_parts": (
        lambda s, sf: parcels_in_parts(s, sf).join(zones(s, sf).withColumnsRenamed(
            {"ring": "zring", "code_insee": "code_insee_source"}), "code_insee_source").select(
            "id_parcel", rings_within(F.col("ring"), F.col("zring")).alias("within")),
        f"""WITH {PARTS_CTE}
SELECT pp.id_parcel, ({_BOTH_PARTS}) AS within FROM pp JOIN fx_communes_geo g ON g.code_insee = pp.code_insee_source"""),
    "l4_drop_empty_geometry": (
        lambda s, sf: G.drop_empty_geometry(zones(s, sf)).select("code_insee"),
        "SELECT code_insee FROM fx_communes_geo WHERE half > 0"),
    "c16_parcels_within": (
        lambda s, sf: G.parcels_within(parcels(s, sf, as_read), zones(s, sf), ["code_insee"], "left", keep=PARCEL_COLS),
        f"SELECT {_PC}, g.code_insee FROM fx_parcelles_geo p LEFT JOIN fx_communes_geo g ON {_within_sql('p', 'g')}"),
    "c16_parts_within": (
        lambda s, sf: G.parcels_within(parcels_in_parts(s, sf, as_read), zones(s, sf), ["code_insee"], "left", keep=["id_parcel"]),
        f"""WITH {PARTS_CTE}
SELECT pp.id_parcel, g.code_insee FROM pp LEFT JOIN fx_communes_geo g ON {_BOTH_PARTS}"""),
    "c17_parcels_of_commune": (
        lambda s, sf: G.parcels_within(parcels(s, sf, as_read), zones(s, sf), ["code_insee"], "inner", keep=PARCEL_COLS),
        f"SELECT {_PC}, g.code_insee FROM fx_parcelles_geo p JOIN fx_communes_geo g ON {_within_sql('p', 'g')}"),
    "c19_nearest_grid_value": (
        lambda s, sf: G.nearest_grid_value(communes_admin(fixture(s, sf, "fx_communes")), fixture(s, sf, "fx_grille"),
                                           -6.0, 40.0, 0.25).select("code_insee", "gi", "gj", "valeur"),
        f"""WITH a AS (SELECT code_insee, {_LON} AS lon, {_LAT} AS lat FROM fx_communes),
b AS (SELECT code_insee, CAST(round((lon + 6.0) / 0.25) AS INTEGER) AS gi, CAST(round((lat - 40.0) / 0.25) AS INTEGER) AS gj FROM a)
SELECT b.code_insee, b.gi, b.gj, g.valeur FROM b LEFT JOIN fx_grille g ON g.gi = b.gi AND g.gj = b.gj"""),
    "c19_nearest_station": (
        lambda s, sf: G.nearest_point(fixture(s, sf, "fx_communes").select("code_insee", F.col("x_l93").alias("x"),
                                                                           F.col("y_l93").alias("y")),
                                      fixture(s, sf, "fx_stations"), "code_insee", "station", "valeur", 16384.0),
        """SELECT code_insee, station, valeur, distance FROM (
 SELECT c.code_insee, s.station, s.valeur, sqrt((c.x_l93 - s.x) * (c.x_l93 - s.x) + (c.y_l93 - s.y) * (c.y_l93 - s.y)) AS distance,
  row_number() OVER (PARTITION BY c.code_insee ORDER BY (c.x_l93 - s.x) * (c.x_l93 - s.x) + (c.y_l93 - s.y) * (c.y_l93 - s.y), s.station) AS rn
 FROM fx_communes c, fx_stations s) WHERE rn = 1"""),
    "b1_rename_existing": (
        lambda s, sf: C.rename_existing(measurement_sheet(fixture(s, sf, "fx_mesures_brut")).drop("Semaine"),
                                        MEASURE_RENAME).select("reseau", "nom_commune", "code_insee", "annee",
                                                               "LQ (ng/m3)"),
        'SELECT aasqa AS reseau, commune AS nom_commune, code_insee_txt AS code_insee, annee, lq AS "LQ (ng/m3)" FROM fx_mesures_brut'),
    "b2_normalise_weather_columns": (
        lambda s, sf: C.normalise_weather_columns(
            fixture(s, sf, "fx_meteo_jour").drop("wind_speed_10m_mean").withColumnsRenamed(
                {"time": "date", "wind_speed_10m_max": "wind_gusts_10m_max"})),
        "SELECT code_insee, time, temperature_2m_max, temperature_2m_min, precipitation_sum, "
        "wind_speed_10m_max AS wind_speed_10m_mean FROM fx_meteo_jour"),
    "b3_map_crop": (
        lambda s, sf: fixture(s, sf, "fx_ift").select("insee_com", C.map_crop("c_maj").alias("c_maj_cal"),
                                                      C.map_crop("c_ift_h").alias("c_ift_h_cal")),
        f"WITH {CROP_MAP_CTE}\nSELECT i.insee_com, m1.dst AS c_maj_cal, m3.dst AS c_ift_h_cal FROM fx_ift i "
        "LEFT JOIN cmap m1 ON i.c_maj = m1.src LEFT JOIN cmap m3 ON i.c_ift_h = m3.src"),
    "b4_pad_insee": (
        lambda s, sf: fixture(s, sf, "fx_mesures_brut").select(
            "event_id", C.pad_insee("code_insee_txt").alias("code_insee"), C.dep_of_insee("code_insee_txt").alias("dep")),
        "SELECT event_id, CASE WHEN length(code_insee_txt) < 5 THEN lpad(code_insee_txt, 5, '0') ELSE code_insee_txt END AS code_insee, "
        "substr(CASE WHEN length(code_insee_txt) < 5 THEN lpad(code_insee_txt, 5, '0') ELSE code_insee_txt END, 1, 2) AS dep "
        "FROM fx_mesures_brut"),
    "b5_parse_concentration": (
        lambda s, sf: fixture(s, sf, "fx_mesures_brut").select(
            "event_id", C.parse_concentration("concentration_txt").alias("concentration_ng_m3"),
            C.detected("concentration_txt").alias("detecte")),
        "SELECT event_id, CASE WHEN concentration_txt LIKE '%<%' THEN CAST(0 AS DOUBLE) ELSE TRY_CAST(concentration_txt AS DOUBLE) END "
        "AS concentration_ng_m3, CASE WHEN concentration_txt LIKE '%<%' THEN FALSE ELSE TRUE END AS detecte FROM fx_mesures_brut"),
    "b6_to_day": (
        lambda s, sf: fixture(s, sf, "fx_mesures_brut").select("event_id", F.to_date("debut_ts").alias("debut_prelevement")),
        "SELECT event_id, CAST(debut_ts AS DATE) AS debut_prelevement FROM fx_mesures_brut"),
    "b7_yes_no": (
        lambda s, sf: fixture(s, sf, "fx_calendrier_brut").select(
            "departement_code", "culture", "debut_txt_date", C.yes_no("herbicides_txt").alias("herbicides"),
            C.yes_no("insecticides_txt").alias("insecticides")),
        "SELECT departement_code, culture, debut_txt_date, lower(herbicides_txt) = 'oui' AS herbicides, "
        "lower(insecticides_txt) = 'oui' AS insecticides FROM fx_calendrier_brut"),
    "b8_treatment_flags": (
        lambda s, sf: fixture(s, sf, "fx_calendrier_idf").select("departement_code", "culture", "periode",
                                                                  *C.treatment_flags("type")),
        "SELECT departement_code, culture, periode, contains(type, 'Herbicides') AS herbicides, "
        "contains(type, 'Fongicides') AS fongicides, contains(type, 'Insecticides') AS insecticides FROM fx_calendrier_idf"),
    "b9_month_period": (
        lambda s, sf: fixture(s, sf, "fx_calendrier_idf").select(
            "departement_code", "culture", "periode", *[c.alias(n) for c, n in zip(C.month_period("periode", 2025),
                                                                                  ("debut", "fin"))]),
        """WITH mo(m, n) AS (VALUES ('janvier', 1), ('février', 2), ('mars', 3), ('avril', 4), ('mai', 5), ('juin', 6),
 ('juillet', 7), ('août', 8), ('septembre', 9), ('octobre', 10), ('novembre', 11), ('décembre', 12))
SELECT i.departement_code, i.culture, i.periode, make_date(2025, mo.n, 1) AS debut, last_day(make_date(2025, mo.n, 1)) AS fin
FROM fx_calendrier_idf i LEFT JOIN mo ON mo.m = lower(i.periode)"""),
    "b10_rebase_failures": (
        lambda s, sf: C.rebase_failures(fixture(s, sf, "fx_calendrier").withColumns(
            {c: F.date_add(c, 366) for c in ("debut_de_periode", "fin_de_periode")}),
            ["debut_de_periode", "fin_de_periode"], 2025),
        "SELECT count(*) FILTER (WHERE month(debut_de_periode + 366) = 2 AND day(debut_de_periode + 366) = 29) AS debut_de_periode, "
        "count(*) FILTER (WHERE month(fin_de_periode + 366) = 2 AND day(fin_de_periode + 366) = 29) AS fin_de_periode "
        "FROM fx_calendrier"),
    "b10_rebase_year": (
        lambda s, sf: rebase_calendar(fixture(s, sf, "fx_calendrier"), 2025),
        "SELECT CAST(departement_code AS STRING) AS departement_code, culture, make_date(2025, month(debut_de_periode), "
        "day(debut_de_periode)) AS debut_de_periode, make_date(2025, month(fin_de_periode), day(fin_de_periode)) AS fin_de_periode, "
        "herbicides, fongicides, insecticides FROM fx_calendrier"),
    "b12_region_name": (
        lambda s, sf: fixture(s, sf, "fx_communes").select("code_insee_reg").distinct().select(
            "code_insee_reg", C.region_name("code_insee_reg", "Inconnue").alias("nom_region")),
        f"WITH {REGION_CTE}\nSELECT DISTINCT c.code_insee_reg, coalesce(r.nom, 'Inconnue') AS nom_region FROM fx_communes c "
        "LEFT JOIN regmap r ON r.code = c.code_insee_reg"),
    "b13_coerce_numeric": (
        lambda s, sf: fixture(s, sf, "fx_mesures_brut").select(
            "event_id", C.coerce_numeric("concentration_txt").alias("valeur"),
            C.coerce_numeric("code_insee_txt", "int").alias("code_num")),
        "SELECT event_id, TRY_CAST(concentration_txt AS DOUBLE) AS valeur, TRY_CAST(code_insee_txt AS INTEGER) AS code_num "
        "FROM fx_mesures_brut"),
    "b14_lowercase_columns": (
        lambda s, sf: C.lowercase_columns(measurement_sheet(fixture(s, sf, "fx_mesures_brut")).select(
            "AASQA", "Commune", "Annee", "LQ (ng/m3)")),
        'SELECT aasqa, commune AS commune, annee AS annee, lq AS "lq (ng/m3)" FROM fx_mesures_brut'),
    "b15_date_spine": (
        lambda s, sf: fixture(s, sf, "fx_meteo").select(F.year("time").alias("annee")).distinct().select(
            "annee", F.explode(F.sequence(F.make_date("annee", F.lit(1), F.lit(1)),
                                          F.date_add(F.make_date("annee", F.lit(1), F.lit(1)),
                                                     F.when(F.col("annee") % 4 == 0, 365).otherwise(364)))).alias("date")),
        "WITH y AS (SELECT DISTINCT CAST(year(time) AS INTEGER) AS annee FROM fx_meteo) "
        "SELECT y.annee, CAST(make_date(y.annee, 1, 1) + CAST(i AS INTEGER) AS DATE) AS date FROM y, range(366) t(i) "
        "WHERE i < CASE WHEN y.annee % 4 = 0 THEN 366 ELSE 365 END"),
    "b18_window_bounds": (
        lambda s, sf: clean(s, sf).select("code_insee", "substance", "debut_prelevement", "fin_prelevement",
                                          *[c.alias(n) for c, n in zip(C.window_bounds("debut_prelevement", "fin_prelevement", 15),
                                                                       ("start_date", "end_date"))]),
        f"WITH {SQL_CLEAN}\nSELECT code_insee, substance, debut_prelevement, fin_prelevement, debut_prelevement - 15 AS start_date, "
        "fin_prelevement + 15 AS end_date FROM clean"),
    "b20_area_small_share": (
        lambda s, sf: fixture(s, sf, "fx_communes_epci").groupBy("code_insee_reg").agg(
            F.sum(C.area_km2("superficie_cadastrale")).alias("surface_km2"),
            F.avg((C.area_km2("superficie_cadastrale") < 81).cast("double")).alias("part_petites")),
        "SELECT code_insee_reg, sum(superficie_cadastrale * 0.01) AS surface_km2, "
        "avg(CAST(superficie_cadastrale * 0.01 < 81 AS DOUBLE)) AS part_petites FROM fx_communes_epci GROUP BY code_insee_reg"),
    "b22_weather_flags_v0": (
        lambda s, sf: fixture(s, sf, "fx_meteo_jour").select("code_insee", "time", *C.weather_flags_v0()),
        "SELECT code_insee, time, wind_speed_10m_max >= 11 AS vent_fort, precipitation_sum >= 0 AS pluie, "
        "wind_speed_10m_max >= 4 AND wind_speed_10m_max < 11 AS dispersion FROM fx_meteo_jour"),
    "c18_region_of_dep": (
        lambda s, sf: AN.region_of_dep(fixture(s, sf, "fx_communes")),
        f"""WITH {REGION_CTE},
d AS (SELECT code_insee_dep, arg_min(code_insee_reg, code_insee) AS code_insee_reg FROM fx_communes GROUP BY code_insee_dep)
SELECT d.*, coalesce(r.nom, 'Inconnue') AS nom_region FROM d LEFT JOIN regmap r ON r.code = d.code_insee_reg"""),
    "d2_regional_mean_periods": (
        lambda s, sf: regional_denominators(denominators(inputs(s, sf).cal), dep_region_bridge(inputs(s, sf).ift)),
        f"""WITH cal AS (SELECT CAST(departement_code AS STRING) AS dep, culture, herbicides, fongicides, insecticides FROM fx_calendrier),
nb AS (SELECT dep, culture, count(*) AS t, count(*) FILTER (WHERE fongicides OR insecticides) AS fi, count(*) FILTER (WHERE herbicides) AS h
 FROM cal GROUP BY dep, culture),
br AS (SELECT DISTINCT code_insee_dep, code_insee_reg FROM fx_ift WHERE ift_t IS NOT NULL)
SELECT br.code_insee_reg, nb.culture, avg(nb.t) AS nb_periodes_total_reg, avg(nb.fi) AS nb_periodes_fongi_insecti_reg,
 avg(nb.h) AS nb_periodes_herbicides_reg FROM nb JOIN br ON br.code_insee_dep = nb.dep GROUP BY br.code_insee_reg, nb.culture"""),
    "d3_region_active": (
        lambda s, sf: region_active_days(distinct_active_days(inputs(s, sf).cal), dep_region_bridge(inputs(s, sf).ift)),
        f"""WITH cal AS (SELECT CAST(departement_code AS STRING) AS dep, culture,
  make_date({ANNEE}, month(debut_de_periode), day(debut_de_periode)) AS d0, make_date({ANNEE}, month(fin_de_periode), day(fin_de_periode)) AS d1,
  herbicides, fongicides, insecticides FROM fx_calendrier),
days AS (SELECT CAST(DATE '{ANNEE}-01-01' + CAST(i AS INTEGER) AS DATE) AS day FROM range(366) t(i)),
act AS (SELECT 'maj' AS cfg, c.dep, c.culture, d.day FROM cal c JOIN days d ON d.day BETWEEN c.d0 AND c.d1
 UNION SELECT 'hbc', c.dep, c.culture, d.day FROM cal c JOIN days d ON d.day BETWEEN c.d0 AND c.d1 WHERE c.fongicides OR c.insecticides
 UNION SELECT 'h', c.dep, c.culture, d.day FROM cal c JOIN days d ON d.day BETWEEN c.d0 AND c.d1 WHERE c.herbicides),
br AS (SELECT DISTINCT code_insee_dep, code_insee_reg FROM fx_ift WHERE ift_t IS NOT NULL)
SELECT DISTINCT a.cfg, br.code_insee_reg, a.culture, a.day AS date FROM act a JOIN br ON br.code_insee_dep = a.dep
WHERE br.code_insee_reg IS NOT NULL"""),
    "d25_null_census": (
        lambda s, sf: AN.null_census(fixture(s, sf, "fx_ift").drop("k")),
        "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in (
            "insee_com", "code_insee_dep", "code_insee_reg", "c_maj", "c_ift_hbc", "c_ift_h", "ift_t", "ift_t_hbc",
            "ift_hh_hbc", "ift_h", "sau", "sau_bio", "p_bio", "p_sau", "iftbc", "cod_c_maj", "cod_c_hbc", "cod_c_h"))
        + " FROM fx_ift"),
    "d26_describe": (
        lambda s, sf: AN.describe(clean(s, sf), ["concentration_ng_m3", "LQ (ng/m3)"]),
        f"WITH {SQL_CLEAN}\n" + " UNION ALL ".join(
            f"SELECT '{c}' AS colonne, count({q}) AS count, round(avg({q}), 6) AS mean, round(stddev_samp({q}), 6) AS std, "
            f"CAST(min({q}) AS DOUBLE) AS min, round(quantile_cont({q}, 0.25), 6) AS q25, round(quantile_cont({q}, 0.5), 6) AS q50, "
            f"round(quantile_cont({q}, 0.75), 6) AS q75, CAST(max({q}) AS DOUBLE) AS max FROM clean"
            for c, q in (("concentration_ng_m3", "concentration_ng_m3"), ("LQ (ng/m3)", '"LQ (ng/m3)"')))),
    "d29_crop_catalogue": (
        lambda s, sf: AN.crop_catalogue(fixture(s, sf, "fx_ift")),
        """WITH l AS (SELECT k, c_maj AS culture, cod_c_maj AS code, 1 AS prio FROM fx_ift
 UNION ALL SELECT k, c_ift_hbc, cod_c_hbc, 2 FROM fx_ift UNION ALL SELECT k, c_ift_h, cod_c_h, 3 FROM fx_ift)
SELECT culture, code FROM (SELECT l.*, row_number() OVER (PARTITION BY culture ORDER BY prio, k) AS rn FROM l WHERE culture IS NOT NULL)
WHERE rn = 1"""),
    "d35_share_of_days": (
        lambda s, sf: AN.share_of_days(fixture(s, sf, "fx_meteo_jour").select("code_insee", *C.weather_flags_v0()),
                                       ["code_insee"], ["vent_fort", "pluie", "dispersion"]),
        "SELECT code_insee, avg(CAST(wind_speed_10m_max >= 11 AS DOUBLE)) AS part_vent_fort, "
        "avg(CAST(precipitation_sum >= 0 AS DOUBLE)) AS part_pluie, "
        "avg(CAST(wind_speed_10m_max >= 4 AND wind_speed_10m_max < 11 AS DOUBLE)) AS part_dispersion FROM fx_meteo_jour GROUP BY code_insee"),
    "d36_area_quantiles": (
        lambda s, sf: AN.area_quantiles(fixture(s, sf, "fx_communes_epci"), "code_insee_reg", "superficie_cadastrale"),
        "SELECT code_insee_reg, " + ", ".join(f"quantile_cont(superficie_cadastrale, {q}) AS {n}" for q, n in (
            (0.0, "min"), (0.25, "q25"), (0.5, "q50"), (0.75, "q75"), (1.0, "max")))
        + " FROM fx_communes_epci GROUP BY code_insee_reg"),
    "d36_area_quantiles_large": (
        lambda s, sf: AN.area_quantiles(fixture(s, sf, "fx_communes_epci"), "code_insee_reg", "superficie_cadastrale", 5000),
        "SELECT code_insee_reg, " + ", ".join(f"quantile_cont(superficie_cadastrale, {q}) AS {n}" for q, n in (
            (0.0, "min"), (0.25, "q25"), (0.5, "q50"), (0.75, "q75"), (1.0, "max")))
        + " FROM fx_communes_epci WHERE superficie_cadastrale > 5000 GROUP BY code_insee_reg"),
    "d38_latest_year_rows": (
        lambda s, sf: AN.latest_year_rows(fixture(s, sf, "fx_meteo_jour").withColumn("annee", F.year("time")),
                                          "annee", ["code_insee", "time"]),
        "WITH m AS (SELECT *, year(time) AS annee FROM fx_meteo_jour) SELECT m.*, row_number() OVER (ORDER BY code_insee, time) AS row_id "
        "FROM m WHERE annee = (SELECT max(annee) FROM m)"),
    "g6_head": (
        lambda s, sf: fixture(s, sf, "fx_meteo").orderBy("code_insee", "time").limit(5),
        "SELECT * FROM fx_meteo ORDER BY code_insee, time LIMIT 5"),
    "g6_tail": (
        lambda s, sf: fixture(s, sf, "fx_meteo").orderBy(F.col("code_insee").desc(), F.col("time").desc()).limit(5),
        "SELECT * FROM fx_meteo ORDER BY code_insee DESC, time DESC LIMIT 5"),
    "h3_concat_missing_column": (
        lambda s, sf: C.add_missing_columns(fixture(s, sf, "fx_calendrier_idf").drop("type"),
                                            fixture(s, sf, "fx_calendrier_brut").select("departement_code", "culture",
                                                                                         "commentaires")),
        "SELECT departement_code, culture, CAST(NULL AS VARCHAR) AS commentaires, periode FROM fx_calendrier_idf"),
    "h4_diagonal_concat": (
        lambda s, sf: fixture(s, sf, "fx_meteo").unionByName(
            fixture(s, sf, "fx_meteo_jour").select("code_insee", "time", "temperature_2m_max", "precipitation_sum"),
            allowMissingColumns=True),
        "SELECT code_insee, time, wind_speed_10m_mean, precipitation_sum, CAST(NULL AS DOUBLE) AS temperature_2m_max FROM fx_meteo "
        "UNION ALL SELECT code_insee, time, NULL, precipitation_sum, temperature_2m_max FROM fx_meteo_jour"),
    "h5_crop_union": (
        lambda s, sf: fixture(s, sf, "fx_ift").select(F.col("c_maj").alias("culture")).union(
            fixture(s, sf, "fx_ift").select("c_ift_hbc")).union(fixture(s, sf, "fx_ift").select("c_ift_h")).distinct(),
        "SELECT c_maj AS culture FROM fx_ift UNION SELECT c_ift_hbc FROM fx_ift UNION SELECT c_ift_h FROM fx_ift"),
    "h6_distinct_windows": (
        lambda s, sf: clean(s, sf).select("code_insee", "debut_prelevement", "fin_prelevement").distinct(),
        f"WITH {SQL_CLEAN}\nSELECT DISTINCT code_insee, debut_prelevement, fin_prelevement FROM clean"),
}
