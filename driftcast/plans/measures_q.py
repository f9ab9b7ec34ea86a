"""Queries of the measurement family (E11, E12, D4, C8, D18–D21, D37,
D39, D40, L5, B1, B4–B6, B17, B18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftcast.fixtures import fixture
from driftcast.functions.geo import lambert93_sql
from driftcast.operators import measures as M
from driftcast.sources.sheets import measurement_sheet


def clean(spark, sf):
    return M.measurements_clean(measurement_sheet(fixture(spark, sf, "fx_mesures_brut")))


def daily(spark, sf):
    return fixture(spark, sf, "fx_meteo_jour")


def _rounded(df):
    return df.withColumns({"longitude": F.round("longitude", 6), "latitude": F.round("latitude", 6)})


_LON, _LAT = lambert93_sql("xlamb93", "ylamb93")
_PAD = "CASE WHEN length(code_insee_txt) < 5 THEN lpad(code_insee_txt, 5, '0') ELSE code_insee_txt END"
SQL_CLEAN = f"""clean AS (
 SELECT aasqa AS reseau, commune AS nom_commune, {_PAD} AS code_insee, xlamb93 AS x_lamb93, ylamb93 AS y_lamb93,
  CAST(debut_ts AS DATE) AS debut_prelevement, CAST(fin_ts AS DATE) AS fin_prelevement, annee, semaine,
  jours AS nb_jours_prelevement, coupure AS type_filtre, prelevement AS nb_prelevement, substance,
  CASE WHEN concentration_txt LIKE '%<%' THEN CAST(0 AS DOUBLE) ELSE TRY_CAST(concentration_txt AS DOUBLE) END AS concentration_ng_m3,
  lq AS "LQ (ng/m3)", substr({_PAD}, 1, 2) AS code_insee_dep,
  CASE WHEN concentration_txt LIKE '%<%' THEN FALSE ELSE TRUE END AS detecte,
  {_LON} AS longitude, {_LAT} AS latitude
 FROM fx_mesures_brut)"""

SQL_AGG = SQL_CLEAN + """,
win AS (SELECT DISTINCT code_insee, debut_prelevement - 15 AS start_date, fin_prelevement + 15 AS end_date
 FROM clean WHERE latitude IS NOT NULL),
agg AS (
 SELECT w.code_insee, w.start_date, w.end_date,
  avg(temperature_2m_max) AS temp_max_moy, avg(temperature_2m_min) AS temp_min_moy, avg(temperature_2m_mean) AS temp_moy,
  avg(wind_speed_10m_max) AS vent_max_moy, avg(wind_speed_10m_mean) AS vent_moy, max(wind_speed_10m_max) AS vent_max_abs,
  coalesce(sum(precipitation_sum), 0) AS precip_totale, avg(precipitation_sum) AS precip_moy_jour,
  avg(relative_humidity_2m_mean) AS humidite_moy, avg(relative_humidity_2m_max) AS humidite_max_moy,
  coalesce(sum(sunshine_duration), 0) / 3600 AS ensoleillement_h_total, avg(sunshine_duration) / 3600 AS ensoleillement_h_moy,
  count(*) FILTER (WHERE wind_speed_10m_max >= 4 AND wind_speed_10m_max < 11) AS nb_jours_dispersion,
  count(*) FILTER (WHERE wind_speed_10m_max >= 11) AS nb_jours_interdiction,
  count(*) FILTER (WHERE precipitation_sum > 0) AS nb_jours_pluie
 FROM win w JOIN fx_meteo_jour j ON j.code_insee = w.code_insee AND j.time BETWEEN w.start_date AND w.end_date
 GROUP BY w.code_insee, w.start_date, w.end_date),
enr AS (
 SELECT c.*, c.debut_prelevement - 15 AS start_date, c.fin_prelevement + 15 AS end_date,
  agg.temp_max_moy, agg.temp_min_moy, agg.temp_moy, agg.vent_max_moy, agg.vent_moy, agg.vent_max_abs,
  agg.precip_totale, agg.precip_moy_jour, agg.humidite_moy, agg.humidite_max_moy, agg.ensoleillement_h_total,
  agg.ensoleillement_h_moy, agg.nb_jours_dispersion, agg.nb_jours_interdiction, agg.nb_jours_pluie
 FROM clean c LEFT JOIN agg ON agg.code_insee = c.code_insee AND agg.start_date = c.debut_prelevement - 15
  AND agg.end_date = c.fin_prelevement + 15)"""

_ROUND = "* REPLACE (round(longitude, 6) AS longitude, round(latitude, 6) AS latitude)"

QUERIES = {
    "e11_measurements_clean": (
        lambda s, sf: _rounded(clean(s, sf)),
        f"WITH {SQL_CLEAN}\nSELECT {_ROUND} FROM clean"),
    "b17_lambert93_to_wgs84": (
        lambda s, sf: fixture(s, sf, "fx_communes").select(
            "code_insee", *[F.round(c, 6).alias(n) for c, n in zip(
                __import__("driftcast.functions.geo", fromlist=["x"]).lambert93_to_wgs84("x_l93", "y_l93"),
                ("longitude", "latitude"))]),
        "SELECT code_insee, round({}, 6) AS longitude, round({}, 6) AS latitude FROM fx_communes".format(
            *lambert93_sql("x_l93", "y_l93"))),
    "d4_weather_window_aggregates": (
        lambda s, sf: M.weather_window_aggregates(M.sampling_windows(clean(s, sf)), daily(s, sf)),
        f"WITH {SQL_AGG}\nSELECT * FROM agg"),
    "e12_measurements_enriched": (
        lambda s, sf: _rounded(M.measurements_enriched(clean(s, sf), daily(s, sf))),
        f"WITH {SQL_AGG}\nSELECT {_ROUND} FROM enr"),
    "d18_measure_totals": (
        lambda s, sf: M.measure_totals(clean(s, sf).where(F.col("code_insee").isNotNull()),
                                       ["code_insee", "nom_commune", "debut_prelevement", "fin_prelevement"]),
        f"""WITH {SQL_CLEAN}
SELECT code_insee, nom_commune, debut_prelevement, fin_prelevement, coalesce(sum(concentration_ng_m3), 0) AS concentration_totale,
 count(DISTINCT CASE WHEN concentration_ng_m3 > 0 THEN substance END) AS nb_substances_detectees
FROM clean WHERE code_insee IS NOT NULL GROUP BY code_insee, nom_commune, debut_prelevement, fin_prelevement"""),
    "d18_measure_totals_by_coordinates": (
        lambda s, sf: M.measure_totals(clean(s, sf), ["x_lamb93", "y_lamb93", "debut_prelevement", "fin_prelevement"]),
        f"""WITH {SQL_CLEAN}
SELECT x_lamb93, y_lamb93, debut_prelevement, fin_prelevement, coalesce(sum(concentration_ng_m3), 0) AS concentration_totale,
 count(DISTINCT CASE WHEN concentration_ng_m3 > 0 THEN substance END) AS nb_substances_detectees
FROM clean GROUP BY x_lamb93, y_lamb93, debut_prelevement, fin_prelevement"""),
    "d19_top_substances": (
        lambda s, sf: M.top_substances(clean(s, sf), 10),
        f"""WITH {SQL_CLEAN},
det AS (SELECT * FROM clean WHERE concentration_ng_m3 > 0),
top AS (SELECT substance FROM det GROUP BY substance ORDER BY sum(concentration_ng_m3) DESC, substance LIMIT 10)
SELECT debut_prelevement, substance, sum(concentration_ng_m3) AS concentration_ng_m3
FROM det WHERE substance IN (SELECT substance FROM top) GROUP BY debut_prelevement, substance"""),
    "d19_total_per_day": (
        lambda s, sf: M.total_per_day(clean(s, sf)),
        f"""WITH {SQL_CLEAN}
SELECT debut_prelevement, sum(concentration_ng_m3) AS concentration_ng_m3 FROM clean
WHERE concentration_ng_m3 > 0 GROUP BY debut_prelevement"""),
    "d20_substance_detail": (
        lambda s, sf: M.substance_detail(clean(s, sf)),
        f"""WITH {SQL_CLEAN}
SELECT substance, count(*) FILTER (WHERE concentration_ng_m3 > 0) AS nb_detections, count(*) AS nb_periodes,
 coalesce(max(CASE WHEN concentration_ng_m3 > 0 THEN concentration_ng_m3 END), 0) AS max_detecte,
 quantile_cont("LQ (ng/m3)", 0.5) AS lq_mediane FROM clean GROUP BY substance"""),
    "d21_substance_ranking": (
        lambda s, sf: M.substance_ranking(clean(s, sf), 15),
        f"""WITH {SQL_CLEAN}
SELECT substance, sum(concentration_ng_m3) AS total, count(concentration_ng_m3) AS n_periodes, max(concentration_ng_m3) AS max
FROM clean WHERE concentration_ng_m3 > 0 GROUP BY substance ORDER BY total DESC, substance LIMIT 15"""),
    "d21_detection_summary": (
        lambda s, sf: M.detection_summary(clean(s, sf)),
        f"""WITH {SQL_CLEAN}
SELECT count(DISTINCT debut_prelevement) AS nb_periodes, count(DISTINCT substance) AS nb_substances,
 count(DISTINCT CASE WHEN concentration_ng_m3 > 0 THEN substance END) AS nb_substances_detectees,
 count(*) FILTER (WHERE concentration_ng_m3 > 0) * 100.0 / count(*) AS taux_detection FROM clean"""),
    "d37_enrichment_rate": (
        lambda s, sf: M.enrichment_rate(M.measurements_enriched(clean(s, sf), daily(s, sf))),
        f"""WITH {SQL_AGG}
SELECT count(*) FILTER (WHERE vent_moy IS NOT NULL) AS nb_enrichies, count(*) AS nb_mesures,
 count(DISTINCT code_insee) AS nb_communes, min(annee) AS annee_min, max(annee) AS annee_max,
 count(DISTINCT CASE WHEN latitude IS NULL THEN code_insee END) AS communes_sans_coords FROM enr"""),
    "d39_sampling_range": (
        lambda s, sf: M.sampling_range(clean(s, sf), daily(s, sf)),
        f"""WITH {SQL_CLEAN},
rng AS (SELECT code_insee, min(debut_prelevement) AS premier, max(fin_prelevement) AS dernier FROM clean GROUP BY code_insee)
SELECT j.*, rng.premier, rng.dernier FROM fx_meteo_jour j JOIN rng ON j.code_insee = rng.code_insee
WHERE j.time BETWEEN rng.premier AND rng.dernier"""),
    "d40_stations_without_code": (
        lambda s, sf: M.stations_without_code(clean(s, sf)),
        f"WITH {SQL_CLEAN}\nSELECT DISTINCT nom_commune, reseau, x_lamb93, y_lamb93 FROM clean WHERE code_insee IS NULL"),
    "l5_barycentre": (
        lambda s, sf: M.barycentre(clean(s, sf), ["code_insee_dep"]).withColumns(
            {"lon": F.round("lon", 6), "lat": F.round("lat", 6)}),
        f"WITH {SQL_CLEAN}\nSELECT code_insee_dep, round(avg(longitude), 6) AS lon, round(avg(latitude), 6) AS lat "
        "FROM clean GROUP BY code_insee_dep"),
}
