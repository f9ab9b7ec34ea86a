"""Queries of the display and query-surface family (C9, C10, C15, C20,
E15–E17, D22, D30, D32, D33, B16, B19, I1–I12)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from driftcast.config import DISPLAY_STATES
from driftcast.fixtures import fixture
from driftcast.functions.columns import hover_day, year_spine
from driftcast.functions.geo import lambert93_sql
from driftcast.operators import display as D
from driftcast.operators.risk import risk_days, risk_forecast, risk_of_day, risk_year
from driftcast.plans import surface as S
from driftcast.plans.measures_q import SQL_CLEAN, clean
from driftcast.plans.risk_q import ANNEE, inputs
from driftcast.plans.sqlparts import CROP_MAP_CTE, REGION_CTE, _q, risk_sql
from driftcast.session import shared_path
from driftcast.sources import tables as TB


def ref(s, sf):
    return D.communes_ref(D.communes_admin(fixture(s, sf, "fx_communes")), fixture(s, sf, "fx_ift"),
                          fixture(s, sf, "fx_calendrier"))


def hist(s, sf):
    return risk_year(inputs(s, sf))


def hist_day(s, sf, day, inp=None):
    """History rows of one day: the spine is generated for it instead of
    filtering the whole year (equal by the recompute-days invariant)."""
    return risk_days(inp or inputs(s, sf), F.array(day), day, day)


def hist_between(s, sf, d0, d1):
    """History rows of the days from ``d0`` to ``d1``."""
    return risk_days(inputs(s, sf), F.sequence(d0, d1), d0, d1)


def fc(s, sf, inp=None):
    return risk_forecast(inp or inputs(s, sf), fixture(s, sf, "fx_meteo_prev"))


def fc_days(s, sf):
    """The days of the forecast file."""
    return fixture(s, sf, "fx_meteo_prev").select(F.col("time").alias("date")).distinct()


def fc_day(s, sf, day, inp=None):
    """Forecast rows of one day (none if the file does not have it)."""
    file = fixture(s, sf, "fx_meteo_prev")
    days = file.where(F.col("time") == day).select(F.array_sort(F.collect_set("time"))).scalar()
    return risk_days(inp or inputs(s, sf), days, day, day, neutral_days=False, weather=file.select(
        "code_insee", "time", "wind_speed_10m_mean", "precipitation_sum"))


def stored_table(s, sf):
    """The year's risk as A12 stores it, partitioned by (annee, dep)."""
    p = shared_path(s, "risk_table")
    TB.upsert_year(s, p, hist(s, sf), ANNEE)
    return TB.read_risk(s, p)


def i4_stored(s, sf):
    day = dt.date(ANNEE, 1, 20)
    return _r6(S.risk_map(ref(s, sf), S.stored_risk(stored_table(s, sf), day, day, ["06"]), F.lit(day), departement="06"))


def i5_stored(s, sf):
    return S.risk_series(ref(s, sf).where(F.col("code_insee_dep") == "06"),
                         S.stored_risk(stored_table(s, sf), D_FROM, D_TO, ["06"]), ANNEE)


def _r6(df):
    return df.withColumns({"longitude": F.round("longitude", 6), "latitude": F.round("latitude", 6)})


def first_fc_day(s, sf):
    return fixture(s, sf, "fx_meteo_prev").select(F.min("time")).scalar()


def last_hist_day(s, sf):
    return fixture(s, sf, "fx_meteo").select(F.max("time")).scalar()


def snapshot(s, sf, prefer="forecast"):
    day = first_fc_day(s, sf) if prefer == "forecast" else last_hist_day(s, sf)
    return D.day_map(ref(s, sf), risk_of_day(inputs(s, sf), fixture(s, sf, "fx_meteo_prev"), day, prefer))


_LON, _LAT = lambert93_sql("x_l93", "y_l93")
STATES_CTE = "st(state_order, state, label, color) AS (VALUES " + ", ".join(
    f"({i}, {_q(k)}, {_q(lab)}, {_q(col)})" for i, (k, lab, col) in enumerate(DISPLAY_STATES)) + ")"
REF_CTE = f"""{CROP_MAP_CTE}, {REGION_CTE}, {STATES_CTE},
adm AS (SELECT code_insee, nom_commune, code_insee_dep, code_insee_reg, {_LON} AS longitude, {_LAT} AS latitude FROM fx_communes),
iftm AS (SELECT i.insee_com, i.code_insee_dep AS code_insee_dep_ift, i.c_maj, m1.dst AS c_maj_cal, i.c_ift_hbc,
  m2.dst AS c_ift_hbc_cal, i.c_ift_h, m3.dst AS c_ift_h_cal, i.ift_t, i.ift_h, i.ift_hh_hbc
 FROM fx_ift i LEFT JOIN cmap m1 ON i.c_maj = m1.src LEFT JOIN cmap m2 ON i.c_ift_hbc = m2.src LEFT JOIN cmap m3 ON i.c_ift_h = m3.src),
calp AS (SELECT DISTINCT CAST(departement_code AS STRING) AS dep, culture FROM fx_calendrier),
ref AS (SELECT a.*, f.*, EXISTS (SELECT 1 FROM calp p WHERE p.dep = a.code_insee_dep
  AND p.culture IN (f.c_maj_cal, f.c_ift_hbc_cal, f.c_ift_h_cal)) AS has_calendar_data
 FROM adm a LEFT JOIN iftm f ON a.code_insee = f.insee_com),
risk AS MATERIALIZED ({risk_sql(ANNEE)}),
fc AS MATERIALIZED ({risk_sql(ANNEE, days_sql="SELECT DISTINCT time AS day FROM fx_meteo_prev", weather="fx_meteo_prev", neutral=False)})"""

_R6 = "* REPLACE (round(longitude, 6) AS longitude, round(latitude, 6) AS latitude)"
MAPCOLS_NO_NAN = ("r.risque_0_4, CASE WHEN isnan(r.ift_journalier_total) THEN NULL ELSE r.ift_journalier_total END "
                  "AS ift_journalier_total, r.interdiction_pulv, r.pluie_limitante, r.risque_dispersion")
MAPCOLS = "r.risque_0_4, r.ift_journalier_total, r.interdiction_pulv, r.pluie_limitante, r.risque_dispersion"


def snap_sql(prefer: str) -> str:
    if prefer == "forecast":
        day = "(SELECT min(time) FROM fx_meteo_prev)"
        cand = f"SELECT *, 1 AS prio, TRUE AS is_forecast FROM fc WHERE date = {day} UNION ALL SELECT *, 2, FALSE FROM risk WHERE date = {day}"
    else:
        day = "(SELECT max(time) FROM fx_meteo)"
        cand = f"SELECT *, 1 AS prio, FALSE AS is_forecast FROM risk WHERE date = {day} UNION ALL SELECT *, 2, TRUE FROM fc WHERE date = {day}"
    return f"""{REF_CTE},
cand AS MATERIALIZED ({cand}),
src AS (SELECT * FROM cand WHERE prio = (SELECT min(prio) FROM cand)),
m AS (SELECT ref.*, {MAPCOLS},
  CASE WHEN NOT coalesce(ref.has_calendar_data, FALSE) THEN 'no_calendar' WHEN r.risque_0_4 IS NULL THEN 'no_data'
   ELSE CAST(r.risque_0_4 AS STRING) END AS state
 FROM ref LEFT JOIN src r ON r.insee_com = ref.code_insee),
snap AS (SELECT m.*, st.state_order, st.label, st.color,
  concat('<b>', m.nom_commune, '</b> (', m.code_insee, ')<br>', 'Dép. ', m.code_insee_dep, ' — ',
   coalesce(rg.nom, 'Autre'), '<br>', CASE WHEN m.risque_0_4 IS NOT NULL THEN concat('Indicateur : ',
   CAST(m.risque_0_4 AS STRING), '<br>') ELSE '' END, st.label) AS hover
 FROM m LEFT JOIN st ON st.state = m.state LEFT JOIN regmap rg ON rg.code = m.code_insee_reg)"""


def no_nan(c: str) -> str:
    return f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"


SERIES_SQL = f"""array_sort(list(struct_pack(date := date, risque_0_4 := risque_0_4,
 ift_journalier_total := {no_nan('ift_journalier_total')}, risque_brut := {no_nan('risque_brut')}, indicateur_meteo := indicateur_meteo, interdiction_pulv := interdiction_pulv,
 pluie_limitante := pluie_limitante, risque_dispersion := risque_dispersion)))"""

D_FROM, D_TO = dt.date(2024, 1, 10), dt.date(2024, 1, 31)

QUERIES = {
    "c10_communes_ref": (lambda s, sf: _r6(ref(s, sf)), f"WITH {REF_CTE}\nSELECT {_R6} FROM ref"),
    "c9_has_calendar_data": (
        lambda s, sf: ref(s, sf).select("code_insee", "has_calendar_data"),
        f"WITH {REF_CTE}\nSELECT code_insee, has_calendar_data FROM ref"),
    "i1_communes_list": (
        lambda s, sf: _r6(S.communes_list(ref(s, sf), region="11", q="customer#0000", limit=50, offset=5)),
        f"WITH {REF_CTE}\nSELECT {_R6} FROM ref WHERE code_insee_reg = '11' AND coalesce(regexp_matches(nom_commune, 'CUSTOMER#0000'), FALSE) "
        "ORDER BY code_insee LIMIT 50 OFFSET 5"),
    "i2_communes_search": (
        lambda s, sf: _r6(S.communes_search(ref(s, sf), "customer#00000012", 20)),
        f"WITH {REF_CTE}\nSELECT {_R6} FROM ref WHERE coalesce(regexp_matches(nom_commune, 'CUSTOMER#00000012'), FALSE) "
        "ORDER BY code_insee LIMIT 20"),
    "i3_commune_detail": (
        lambda s, sf: _r6(S.commune_detail(ref(s, sf), fixture(s, sf, "fx_communes").select(F.min("code_insee")).scalar())),
        f"WITH {REF_CTE}\nSELECT {_R6} FROM ref WHERE code_insee = (SELECT min(code_insee) FROM fx_communes)"),
    "i4_risk_map": (
        lambda s, sf: _r6(S.risk_map(ref(s, sf), hist_day(s, sf, last_hist_day(s, sf)), last_hist_day(s, sf),
                                     region="11")),
        f"WITH {REF_CTE}\nSELECT ref.* REPLACE (round(longitude, 6) AS longitude, round(latitude, 6) AS latitude), {MAPCOLS_NO_NAN} "
        "FROM ref LEFT JOIN (SELECT * FROM risk WHERE date = (SELECT max(time) FROM fx_meteo)) r ON r.insee_com = ref.code_insee "
        "WHERE ref.code_insee_reg = '11'"),
    "i4_risk_map_stored": (
        i4_stored,
        f"WITH {REF_CTE}\nSELECT ref.* REPLACE (round(longitude, 6) AS longitude, round(latitude, 6) AS latitude), {MAPCOLS_NO_NAN} "
        f"FROM ref LEFT JOIN (SELECT * FROM risk WHERE date = DATE '{ANNEE}-01-20') r ON r.insee_com = ref.code_insee "
        "WHERE ref.code_insee_dep = '06'"),
    "i5_risk_series_stored": (
        i5_stored,
        f"""WITH {REF_CTE},
s AS (SELECT insee_com, {SERIES_SQL} AS jours FROM risk WHERE date BETWEEN DATE '{D_FROM}' AND DATE '{D_TO}' GROUP BY insee_com)
SELECT ref.code_insee, ref.nom_commune, ref.has_calendar_data, coalesce(s.jours, []) AS jours, {ANNEE} AS annee
FROM ref LEFT JOIN s ON s.insee_com = ref.code_insee WHERE ref.code_insee_dep = '06'"""),
    "i6_forecast_map": (
        lambda s, sf: _r6(S.forecast_map(ref(s, sf), fc_day(s, sf, first_fc_day(s, sf)), first_fc_day(s, sf), fc_days(s, sf), departement="06")),
        f"WITH {REF_CTE}\nSELECT ref.* REPLACE (round(longitude, 6) AS longitude, round(latitude, 6) AS latitude), {MAPCOLS_NO_NAN} "
        "FROM ref LEFT JOIN (SELECT * FROM fc WHERE date = (SELECT min(time) FROM fx_meteo_prev)) r ON r.insee_com = ref.code_insee "
        "WHERE ref.code_insee_dep = '06'"),
    "i5_risk_series": (
        lambda s, sf: S.risk_series(ref(s, sf), hist_between(
            s, sf, fixture(s, sf, "fx_meteo").select(F.min("time")).scalar(), last_hist_day(s, sf)), ANNEE),
        f"""WITH {REF_CTE},
s AS (SELECT insee_com, {SERIES_SQL} AS jours FROM risk
 WHERE year(date) = {ANNEE} AND date >= (SELECT min(time) FROM fx_meteo) AND date <= (SELECT max(time) FROM fx_meteo) GROUP BY insee_com)
SELECT ref.code_insee, ref.nom_commune, ref.has_calendar_data, coalesce(s.jours, []) AS jours, {ANNEE} AS annee
FROM ref LEFT JOIN s ON s.insee_com = ref.code_insee"""),
    "i7_forecast_series": (
        lambda s, sf: S.risk_series(ref(s, sf), fc(s, sf)),
        f"""WITH {REF_CTE},
s AS (SELECT insee_com, {SERIES_SQL} AS jours, year(min(date)) AS annee FROM fc GROUP BY insee_com)
SELECT ref.code_insee, ref.nom_commune, ref.has_calendar_data, coalesce(s.jours, []) AS jours,
 coalesce(s.annee, year(current_date)) AS annee
FROM ref LEFT JOIN s ON s.insee_com = ref.code_insee"""),
    "i8_calendar_query": (
        lambda s, sf: S.calendar_query(fixture(s, sf, "fx_calendrier"), culture="ma", departement_code=12),
        "SELECT departement_code, culture, debut_de_periode AS debut, fin_de_periode AS fin, herbicides, fongicides, insecticides "
        "FROM fx_calendrier WHERE culture ILIKE '%ma%' AND departement_code = 12 ORDER BY departement_code, culture, debut, fin"),
    "i9_measurements_query": (
        lambda s, sf: S.measurements_query(clean(s, sf), clean(s, sf).select(F.min("code_insee")).scalar(),
                                           substance="s1", detected_only=True, limit=500),
        f"""WITH {SQL_CLEAN}
SELECT code_insee, nom_commune, substance, debut_prelevement, fin_prelevement, annee, semaine, concentration_ng_m3, detecte
FROM clean WHERE code_insee = (SELECT min(code_insee) FROM clean) AND substance ILIKE '%s1%' AND detecte = TRUE
ORDER BY debut_prelevement, substance, fin_prelevement, concentration_ng_m3 NULLS FIRST, detecte LIMIT 500"""),
    "i10_selection_options": (
        lambda s, sf: S.selection_options(ref(s, sf), region="11", departement="06"),
        f"""WITH {REF_CTE}
SELECT DISTINCT 'region' AS niveau, code_insee_reg AS valeur FROM ref UNION
SELECT DISTINCT 'departement', code_insee_dep FROM ref WHERE code_insee_reg = '11' UNION
SELECT DISTINCT 'commune', code_insee FROM ref WHERE code_insee_reg = '11' AND code_insee_dep = '06'"""),
    "i11_risk_between": (
        lambda s, sf: S.risk_between(hist_between(s, sf, F.lit(D_FROM), F.lit(D_TO)), fc(s, sf),
                                     F.lit(D_FROM), F.lit(D_TO)),
        f"""WITH {REF_CTE}
SELECT *, FALSE AS is_forecast FROM risk WHERE date BETWEEN DATE '{D_FROM}' AND DATE '{D_TO}'
UNION ALL SELECT *, TRUE FROM fc WHERE date BETWEEN DATE '{D_FROM}' AND DATE '{D_TO}'"""),
    "i11_measurements_within": (
        lambda s, sf: S.measurements_within(clean(s, sf), F.lit(D_FROM), F.lit(D_TO)).drop("longitude", "latitude"),
        f"WITH {SQL_CLEAN}\nSELECT * EXCLUDE (longitude, latitude) FROM clean WHERE debut_prelevement >= DATE '{D_FROM}' "
        f"AND fin_prelevement <= DATE '{D_TO}'"),
    "e16_map_snapshot": (
        lambda s, sf: _r6(snapshot(s, sf, "forecast")),
        f"WITH {snap_sql('forecast')}\nSELECT {_R6} FROM snap"),
    "e16_map_snapshot_history": (
        lambda s, sf: _r6(snapshot(s, sf, "history")),
        f"WITH {snap_sql('history')}\nSELECT {_R6} FROM snap"),
    "e15_display_state": (
        lambda s, sf: snapshot(s, sf, "history").select("code_insee", "state", "state_order", "label", "color"),
        f"WITH {snap_sql('history')}\nSELECT code_insee, state, state_order, label, color FROM snap"),
    "b19_hover_day": (
        lambda s, sf: S.risk_between(hist_between(s, sf, F.lit(D_FROM), F.lit(D_TO)), fc(s, sf), F.lit(D_FROM), F.lit(D_TO))
        .select("insee_com", "date", "is_forecast", hover_day(
            "is_forecast", "date", "risque_0_4", "ift_journalier_total", "interdiction_pulv", "pluie_limitante").alias("hover")),
        f"""WITH {REF_CTE},
u AS (SELECT *, FALSE AS is_forecast FROM risk WHERE date BETWEEN DATE '{D_FROM}' AND DATE '{D_TO}'
 UNION ALL SELECT *, TRUE FROM fc WHERE date BETWEEN DATE '{D_FROM}' AND DATE '{D_TO}')
SELECT insee_com, date, is_forecast, concat(CASE WHEN is_forecast THEN '⚡ Prévision — ' ELSE '' END,
 strftime(date, '%d/%m/%Y'), '<br>Indicateur : ', coalesce(CAST(risque_0_4 AS VARCHAR), '—'), '<br>',
 CASE WHEN ift_journalier_total IS NULL OR isnan(ift_journalier_total) THEN ''
  ELSE concat('IFT journalier : ', CASE WHEN isinf(ift_journalier_total) THEN 'inf' ELSE printf('%.3f', ift_journalier_total) END, '<br>') END,
 CASE WHEN interdiction_pulv THEN '🚫 Vent fort ' ELSE '' END, CASE WHEN pluie_limitante THEN '🌧 Pluie' ELSE '' END) AS hover
FROM u"""),
    "b19_hover_text": (
        lambda s, sf: snapshot(s, sf, "forecast").select("code_insee", "hover"),
        f"WITH {snap_sql('forecast')}\nSELECT code_insee, hover FROM snap"),
    "i12_commune_day": (
        lambda s, sf: S.commune_day(snapshot(s, sf, "history")),
        f"""WITH {snap_sql('history')}
SELECT code_insee, nom_commune, risque_0_4, ift_journalier_total, interdiction_pulv, pluie_limitante, risque_dispersion,
 c_maj_cal, c_ift_hbc_cal, c_ift_h_cal, NOT has_calendar_data AS hors_calendrier, state, label FROM snap"""),
    "d22_state_counts": (
        lambda s, sf: D.state_counts(snapshot(s, sf, "history")),
        f"""WITH {snap_sql('history')},
c AS (SELECT st.state, st.state_order, CAST(coalesce(n.k, 0) AS BIGINT) AS nb_communes FROM st
 LEFT JOIN (SELECT state, count(*) AS k FROM snap GROUP BY state) n ON n.state = st.state)
SELECT * FROM c UNION ALL SELECT 'moderate', CAST(NULL AS INTEGER), CAST(coalesce(sum(nb_communes), 0) AS BIGINT) FROM c
WHERE state IN ('2', '3')"""),
    "e17_commune_series": (
        lambda s, sf: D.commune_series(hist(s, sf), fc(s, sf), keep="both"),
        f"WITH {REF_CTE}\nSELECT *, FALSE AS is_forecast FROM risk UNION ALL SELECT *, TRUE FROM fc"),
    "e17_commune_series_history_first": (
        lambda s, sf: D.commune_series(hist(s, sf), fc(s, sf), keep="history"),
        f"""WITH {REF_CTE},
u AS (SELECT *, 0 AS p FROM risk UNION ALL SELECT *, 1 FROM fc),
k AS (SELECT * FROM (SELECT u.*, row_number() OVER (PARTITION BY insee_com, date ORDER BY p) AS rn FROM u) WHERE rn = 1),
fd AS (SELECT DISTINCT insee_com, date FROM fc)
SELECT k.* EXCLUDE (p, rn), fd.date IS NOT NULL AS is_forecast FROM k LEFT JOIN fd ON fd.insee_com = k.insee_com AND fd.date = k.date"""),
    "c20_compare_communes": (
        lambda s, sf: S.compare_communes(
            hist_between(s, sf, F.lit(D_FROM), F.lit(D_TO)), fixture(s, sf, "fx_communes"),
            fixture(s, sf, "fx_communes").where(F.col("code_insee_dep") == "06"),
            F.lit(D_FROM), F.lit(D_TO)),
        f"""WITH {REF_CTE}
SELECT r.*, c.nom_commune FROM risk r LEFT JOIN fx_communes c ON c.code_insee = r.insee_com
WHERE r.insee_com IN (SELECT code_insee FROM fx_communes WHERE code_insee_dep = '06') AND r.date BETWEEN DATE '{D_FROM}' AND DATE '{D_TO}'"""),
    "d30_years": (
        lambda s, sf: S.distinct_values(hist(s, sf), F.year("date"), "annee"),
        f"WITH {REF_CTE}\nSELECT DISTINCT year(date) AS annee FROM risk"),
    "d30_forecast_days": (
        lambda s, sf: S.distinct_values(fc(s, sf), "date", "date"),
        f"WITH {REF_CTE}\nSELECT DISTINCT date FROM fc"),
    "d30_calendar_crops": (
        lambda s, sf: S.distinct_values(fixture(s, sf, "fx_calendrier"), "culture", "culture"),
        "SELECT DISTINCT culture FROM fx_calendrier"),
    "d30_stations": (
        lambda s, sf: S.distinct_values(clean(s, sf), "code_insee", "code_insee"),
        f"WITH {SQL_CLEAN}\nSELECT DISTINCT code_insee FROM clean"),
    "d30_distinct_communes": (
        lambda s, sf: fixture(s, sf, "fx_ift").select(F.count_distinct("insee_com").alias("nb_communes")),
        "SELECT count(DISTINCT insee_com) AS nb_communes FROM fx_ift"),
    "d32_health_summary": (
        lambda s, sf: S.health_summary(ref(s, sf), hist(s, sf)),
        f"WITH {REF_CTE}\nSELECT (SELECT count(*) FROM ref) AS nb_communes, array_sort(list(DISTINCT year(date))) AS annees FROM risk"),
    "d33_map_centre": (
        lambda s, sf: D.map_centre(ref(s, sf).where(F.col("code_insee_reg") == "11")).select(
            F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon")),
        f"WITH {REF_CTE}\nSELECT round(coalesce(avg(latitude), 46.5), 6) AS lat, round(coalesce(avg(longitude), 2.3), 6) AS lon "
        "FROM ref WHERE code_insee_reg = '11'"),
    "d33_map_centre_empty": (
        lambda s, sf: D.map_centre(ref(s, sf).where(F.col("code_insee_reg") == "99")),
        f"WITH {REF_CTE}\nSELECT coalesce(avg(latitude), 46.5) AS lat, coalesce(avg(longitude), 2.3) AS lon "
        "FROM ref WHERE code_insee_reg = '99'"),
    "b16_available_dates": (
        lambda s, sf: D.available_dates(s, ANNEE, F.lit(dt.date(2024, 1, 20)), fixture(s, sf, "fx_meteo_prev")),
        f"""SELECT DISTINCT date FROM (SELECT CAST(DATE '{ANNEE}-01-01' + CAST(i AS INTEGER) AS DATE) AS date FROM range(366) t(i)
 WHERE CAST(DATE '{ANNEE}-01-01' + CAST(i AS INTEGER) AS DATE) <= DATE '2024-01-20'
 UNION SELECT time FROM fx_meteo_prev) x"""),
}
