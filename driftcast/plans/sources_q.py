"""Queries of the sources/sinks, static build and incremental families
(A1–A17, C1, E10, E13, E14, D31, B11, J1, J3). Writes go under the shared
checkpoint folder, one fresh directory per call."""

from __future__ import annotations

import dataclasses
import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from driftcast.config import Thresholds
from driftcast.fixtures import fixture
from driftcast.functions.geo import lambert93_sql
from driftcast.operators import display as D
from driftcast.operators import static as ST
from driftcast.operators import measures as M
from driftcast.operators import weather as W
from driftcast.operators.calendar import build_calendar
from driftcast.operators.risk import risk_forecast, risk_year
from driftcast.plans.risk_q import ANNEE, inputs
from driftcast.plans.sqlparts import level, risk_sql
from driftcast.session import shared_path
from driftcast.sources import tables as TB
from driftcast.sources import versions
from driftcast.plans.measures_q import SQL_CLEAN, clean
from driftcast.sources.sheets import measurement_sheet
from driftcast.streaming.incremental import (
    ingest_landed_weather, late_weather_repair, upsert_weather, weather_changes, write_late_repair)

TODAY = dt.date(2024, 1, 31)


def adm(s, sf):
    return D.communes_admin(fixture(s, sf, "fx_communes"))


def _r6(df):
    return df.withColumns({"longitude": F.round("longitude", 6), "latitude": F.round("latitude", 6)})


_LON, _LAT = lambert93_sql("x_l93", "y_l93")
ADM_CTE = (f"adm AS (SELECT code_insee, nom_commune, code_insee_dep, code_insee_reg, {_LON} AS longitude, "
           f"{_LAT} AS latitude FROM fx_communes)")
_R6 = "* REPLACE (round(longitude, 6) AS longitude, round(latitude, 6) AS latitude)"

IFT_BUILD_CTE = """nom AS (SELECT code_culture, max(libelle_culture) AS libelle_culture FROM fx_nomenclature GROUP BY code_culture),
d AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY insee_com ORDER BY id) AS rn FROM fx_ift_csv c) WHERE rn = 1),
ift AS (SELECT d.* EXCLUDE (rn), n1.libelle_culture AS c_maj_depuis_code, n2.libelle_culture AS c_ift_hbc_depuis_code,
  n3.libelle_culture AS c_ift_h_depuis_code, substr(d.insee_com, 1, 2) AS code_insee_dep
 FROM d LEFT JOIN nom n1 ON n1.code_culture = d.cod_c_maj LEFT JOIN nom n2 ON n2.code_culture = d.cod_c_hbc
  LEFT JOIN nom n3 ON n3.code_culture = d.cod_c_h)"""
ENRICHI_CTE = f"""{ADM_CTE}, {IFT_BUILD_CTE},
enr AS (SELECT ift.*, a.nom_commune, a.code_insee_dep AS code_insee_dep_right, a.code_insee_reg, a.longitude, a.latitude
 FROM ift LEFT JOIN adm a ON a.code_insee = ift.insee_com)"""


def built_ift(s, sf):
    return ST.build_ift(fixture(s, sf, "fx_ift_csv"), fixture(s, sf, "fx_nomenclature"))


def enriched(s, sf):
    return ST.enrich_ift(built_ift(s, sf)[0], adm(s, sf))


def q_read_delimited(s, sf):
    p = shared_path(s, "idf_csv")
    fixture(s, sf, "fx_calendrier_idf").write.option("header", True).option("sep", ";").csv(p)
    return TB.read_delimited(s, p, "departement_code INT, culture STRING, periode STRING, type STRING")


def q_read_sheet(s, sf):
    p = shared_path(s, "sheet")
    measurement_sheet(fixture(s, sf, "fx_mesures_brut")).write.parquet(p)
    df = TB.read_sheet(s, p)
    return df.withColumns({"Debut prelevement": F.to_date("Debut prelevement"),
                           "Fin prelevement": F.to_date("Fin prelevement")})


def q_read_partitioned(s, sf):
    p = shared_path(s, "risk")
    # one year, so its folder is known: partitionBy would compute and compare
    # the folder of every commune x day row
    risk_year(inputs(s, sf)).write.parquet(f"{p}/annee={ANNEE}")
    return TB.read_partitioned(s, p)


def q_save_weather(s, sf):
    p = shared_path(s, "meteo")
    return TB.save_weather(fixture(s, sf, "fx_meteo"), p, ANNEE)


def q_read_weather_folder(s, sf):
    p = shared_path(s, "meteo")
    TB.save_weather(fixture(s, sf, "fx_meteo"), p, ANNEE).collect()
    return TB.read_partitioned(s, f"{p}/historique", hive=False)


def q_union_years(s, sf):
    p = shared_path(s, "indic")
    m = fixture(s, sf, "fx_meteo")
    m.write.parquet(f"{p}/indicateurs_meteo_{ANNEE}.parquet")
    m.withColumn("time", F.date_sub("time", 366)).write.parquet(f"{p}/indicateurs_meteo_{ANNEE - 1}.parquet")
    m.write.parquet(f"{p}/indicateurs_meteo_{ANNEE}_v2.parquet")  # not a year file: ignored
    return TB.union_years(s, p)


def q_union_forecasts(s, sf):
    p = shared_path(s, "prev")
    f = fixture(s, sf, "fx_meteo_prev").join(
        fixture(s, sf, "fx_communes").select("code_insee", F.col("code_insee_reg").alias("region")), "code_insee")
    f.write.partitionBy("region").parquet(f"{p}/indicateurs_previsions")
    return TB.union_forecasts(s, p, "code_insee string, time date, wind_speed_10m_mean double, "
                                    "precipitation_sum double, region string")


def q_register_and_count(s, sf, counts: bool):
    p = shared_path(s, "views")
    fixture(s, sf, "fx_communes").write.parquet(f"{p}/communes")
    fixture(s, sf, "fx_calendrier").write.parquet(f"{p}/calendrier")
    paths = {"v_communes": f"{p}/communes", "v_calendrier": f"{p}/calendrier", "v_absente": f"{p}/absente"}
    reg = TB.register_views(s, paths)
    if not counts:
        return reg
    return TB.table_counts(s, ["v_communes", "v_calendrier", "v_jamais_creee"])


def q_static_full(s, sf):
    """A17 end to end: row counts of every table it writes."""
    from driftcast.plans.misc_q import as_read, parcels, zones
    z = zones(s, sf).join(fixture(s, sf, "fx_communes").drop("x_l93", "y_l93", "k"), "code_insee")
    raw = fixture(s, sf, "fx_calendrier_brut").select(
        "departement_code", "culture", F.col("debut_txt_date").alias("debut_de_periode"),
        F.col("fin_txt_date").alias("fin_de_periode"), F.col("herbicides_txt").alias("herbicides"),
        F.col("fongicides_txt").alias("fongicides"), F.col("insecticides_txt").alias("insecticides"), "commentaires")
    nom = fixture(s, sf, "fx_nomenclature")
    paths = ST.build_static_from_sources(
        s, shared_path(s, "static"), z, fixture(s, sf, "fx_ift_csv"), {"a": nom, "b": nom, "c": nom}, raw, ANNEE,
        fixture(s, sf, "fx_calendrier_idf"), parcels(s, sf, as_read).withColumn("code_group", F.lit("1")))
    out = None
    for name, path in paths.items():
        part = s.read.parquet(path).select(F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


def _static_full_sql() -> str:
    from driftcast.plans.misc_q import _within_sql
    return f"""WITH det AS (SELECT DISTINCT g.code_insee FROM fx_parcelles_geo p LEFT JOIN fx_communes_geo g ON {_within_sql('p', 'g')}),
names AS (SELECT DISTINCT c.nom_commune FROM det LEFT JOIN fx_communes c ON c.code_insee = det.code_insee)
SELECT 'communes_admin' AS tbl, count(*) AS n FROM fx_communes_geo
UNION ALL SELECT 'ift_communes', count(DISTINCT insee_com) FROM fx_ift_csv
UNION ALL SELECT 'ift_communes_enrichi', count(DISTINCT insee_com) FROM fx_ift_csv
UNION ALL SELECT 'calendrier_epandage', (SELECT count(*) FROM fx_calendrier_brut) + (SELECT count(*) FROM fx_calendrier_idf)
UNION ALL SELECT 'nomenclature_annexe_a', count(*) FROM fx_nomenclature
UNION ALL SELECT 'nomenclature_annexe_b', count(*) FROM fx_nomenclature
UNION ALL SELECT 'nomenclature_annexe_c', count(*) FROM fx_nomenclature
UNION ALL SELECT 'communes_details', count(*) FROM names"""


def stored_weather(s, sf):
    """The weather as stored before a night's repair: some values were revised
    since, a whole day and some communes of another are missing."""
    late = F.dayofmonth("time") == 10
    return fixture(s, sf, "fx_meteo").where(~(F.dayofmonth("time") == 12) & ~(
        (F.dayofmonth("time") == 15) & (F.substring("code_insee", 8, 1) == "4"))).withColumn(
        "wind_speed_10m_mean", F.when(late & F.substring("code_insee", 8, 1).isin("3", "7"),
                                      F.col("wind_speed_10m_mean") + 2).otherwise(F.col("wind_speed_10m_mean")))


def stored_inputs(s, sf):
    return dataclasses.replace(inputs(s, sf), weather=stored_weather(s, sf), memo={})


MERGED_CTE = """lastd AS (SELECT max(time) AS m FROM fx_meteo_era5 WHERE precipitation_sum IS NOT NULL),
mw AS (SELECT code_insee, time, wind_speed_10m_mean, precipitation_sum FROM fx_meteo_era5 WHERE precipitation_sum IS NOT NULL
 UNION ALL SELECT a.code_insee, a.time, a.wind_speed_10m_mean, a.precipitation_sum FROM fx_meteo_archive a, lastd
 WHERE a.time >= coalesce(lastd.m + 1, DATE '2024-01-01') AND a.time <= DATE '2024-01-30')"""

REPAIRED_CTE = f"""{MERGED_CTE},
st AS (SELECT code_insee, time, wind_speed_10m_mean + CASE WHEN day(time) = 10 AND substr(code_insee, 8, 1) IN ('3', '7') THEN 2 ELSE 0 END
  AS wind_speed_10m_mean, precipitation_sum FROM fx_meteo
 WHERE day(time) <> 12 AND NOT (day(time) = 15 AND substr(code_insee, 8, 1) = '4')),
up AS (SELECT code_insee, time, wind_speed_10m_mean, precipitation_sum FROM mw
 UNION ALL SELECT * FROM st WHERE NOT EXISTS (SELECT 1 FROM mw WHERE mw.code_insee = st.code_insee AND mw.time = st.time)),
changed AS (SELECT code_insee, time, wind_speed_10m_mean, precipitation_sum FROM mw EXCEPT SELECT * FROM st)"""


def repair_tables(s, sf):
    """J3 with its write-back: (weather table, risk table) after the repair.
    The stored rows carry epoch stamps."""
    weather, risk = shared_path(s, "weather_hist"), shared_path(s, "risk_table")
    inp = stored_inputs(s, sf)
    TB.upsert_year(s, risk, risk_year(inp), ANNEE)
    upsert_weather(s, weather, inp.weather.withColumn("fetched_at", F.lit(1704931200).cast("long")))
    write_late_repair(s, inp, fixture(s, sf, "fx_meteo_era5"), fixture(s, sf, "fx_meteo_archive"), TODAY, weather, risk)
    return weather, risk


def q_repair_written(s, sf):
    return TB.read_risk(s, repair_tables(s, sf)[1])


def q_repaired_weather(s, sf):
    return versions.read(s, repair_tables(s, sf)[0]).drop("annee", "mois", "fetched_at")


def q_sorted_table(s, sf):
    """G1: the stored risk rows carry their place in (commune, day) order
    within each written file; a row out of order is returned."""
    p = shared_path(s, "risk_table")
    TB.upsert_year(s, p, risk_year(inputs(s, sf)), ANNEE)
    return out_of_order(TB.read_risk(s, p).select(
        "insee_com", "date", F.input_file_name().alias("f"), F.col("_metadata.row_index").alias("i")))


def out_of_order(t, block: int = 8192):
    """The rows (insee_com, date, file ``f``, place ``i``) that do not come
    after the row before them. Rows are compared within blocks of a file, the
    last row of a block being the first of the next, too: one narrow shuffle of
    stretches that are still in order, and no file is one group."""
    at = F.floor(F.col("i") / block)
    rows = t.select("insee_com", "date", F.xxhash64("f").alias("f"), "i", F.explode(F.when(
        (F.col("i") + 1) % block == 0, F.array(at, at + 1)).otherwise(F.array(at))).alias("b"))
    w = Window.partitionBy("f", "b").orderBy("i")
    now = F.struct("insee_com", "date")
    return rows.select("insee_com", "date", (F.lag(now).over(w) >= now).alias("late")).where("late").select("insee_com", "date")


def q_upsert(s, sf):
    p = shared_path(s, "risk_table")
    TB.upsert_year(s, p, risk_year(inputs(s, sf)), ANNEE)
    th = Thresholds(level_cuts=(0.5, 1.0, 2.0))
    TB.upsert_year(s, p, risk_year(inputs(s, sf, region="Île-de-France"), th), ANNEE)
    return TB.read_risk(s, p)


def q_upsert_days(s, sf):
    """J2 + A12 by (commune, day): the late days recomputed (here with other
    level cut points, to see them land) replace only their rows."""
    from driftcast.operators.risk import risk_days
    p = shared_path(s, "risk_days_table")
    inp = inputs(s, sf)
    TB.upsert_year(s, p, risk_year(inp), ANNEE)
    days = (fixture(s, sf, "fx_meteo").where(F.dayofmonth("time") > 20)
            .select(F.array_sort(F.collect_set("time"))).scalar())
    TB.upsert_year(s, p, risk_days(inp, days, th=Thresholds(level_cuts=(0.5, 1.0, 2.0))), ANNEE,
                   key=["insee_com", "date"])
    return TB.read_risk(s, p)


def q_replace_forecasts(s, sf):
    p = shared_path(s, "prev_table")
    f = risk_forecast(inputs(s, sf), fixture(s, sf, "fx_meteo_prev"))
    TB.replace_table(f.where(F.col("date") < F.lit(dt.date(2024, 1, 27))), p)
    TB.replace_table(f, p)
    return s.read.parquet(p)


def q_cached(s, sf):
    p = shared_path(s, "cache")
    first = TB.cached(s, p, lambda: fixture(s, sf, "fx_meteo_jour"))
    return TB.cached(s, p, lambda: first.limit(0))  # second call reuses the stored table


def q_ingest(s, sf):
    land, table, ck = shared_path(s, "landing"), shared_path(s, "weather_hist"), shared_path(s, "ingest_ck")
    era5 = F.substring("code_insee", 8, 1).isin("0", "3", "6", "9")
    m1 = fixture(s, sf, "fx_meteo").where(F.dayofmonth("time") <= 20)
    m2 = fixture(s, sf, "fx_meteo_archive")
    W.to_landed(m1, era5, 1).select(F.to_json(F.struct("code_insee", "fetched_at",
        F.from_json("daily_json", "time array<string>, precipitation_sum array<double>, "
                    "wind_speed_10m_mean array<double>, precipitation_sum_era5 array<double>, "
                    "wind_speed_10m_mean_era5 array<double>").alias("daily")))).write.text(f"{land}/fetch=1")
    W.to_landed(m2, era5, 2).select(F.to_json(F.struct("code_insee", "fetched_at",
        F.from_json("daily_json", "time array<string>, precipitation_sum array<double>, "
                    "wind_speed_10m_mean array<double>, precipitation_sum_era5 array<double>, "
                    "wind_speed_10m_mean_era5 array<double>").alias("daily")))).write.text(f"{land}/fetch=2")
    # communes landed without any daily block are skipped
    fixture(s, sf, "fx_communes").where(F.col("k") % 11 == 0).select(F.to_json(F.struct(
        "code_insee", F.lit(3).cast("long").alias("fetched_at")))).write.text(f"{land}/fetch=3")
    ingest_landed_weather(s, land, table, ck)
    ingest_landed_weather(s, land, table, ck)  # rerun: nothing new, same table
    return versions.read(s, table).drop("annee", "mois")


def q_landed(s, sf):
    p = shared_path(s, "landed")
    era5 = F.substring("code_insee", 8, 1).isin("0", "3", "6", "9")
    W.to_landed(fixture(s, sf, "fx_meteo"), era5, 1).select(F.to_json(F.struct(
        "code_insee", "fetched_at", F.from_json("daily_json", "time array<string>, precipitation_sum array<double>, "
        "wind_speed_10m_mean array<double>, precipitation_sum_era5 array<double>, "
        "wind_speed_10m_mean_era5 array<double>").alias("daily")))).write.text(p)
    return W.read_landed_weather(s, p).drop("fetched_at")


QUERIES = {
    "a1_load_communes": (
        lambda s, sf: _r6(TB.load_communes(adm(s, sf), "Île-de-France")),
        f"WITH {ADM_CTE}\nSELECT {_R6} FROM adm WHERE code_insee_reg = '11'"),
    "a2_read_delimited": (q_read_delimited, "SELECT * FROM fx_calendrier_idf"),
    "a3_read_sheet": (
        q_read_sheet,
        """SELECT aasqa AS "AASQA", commune AS "Commune", code_insee_txt AS "Code INSEE", xlamb93, ylamb93,
 CAST(debut_ts AS DATE) AS "Debut prelevement", CAST(fin_ts AS DATE) AS "Fin prelevement", annee AS "Annee",
 semaine AS "Semaine", jours AS "jours de prelevement", coupure AS "Coupure PM", prelevement, substance AS "substance active",
 concentration_txt AS "Concentration (ng/m3)", lq AS "LQ (ng/m3)" FROM fx_mesures_brut"""),
    "a4_read_partitioned": (q_read_partitioned, f"WITH risk AS ({risk_sql(ANNEE)})\nSELECT *, {ANNEE} AS annee FROM risk"),
    "a4_read_plain_folders": (q_read_weather_folder, "SELECT * FROM fx_meteo"),
    "a5_union_years": (
        q_union_years,
        f"SELECT *, {ANNEE} AS annee FROM fx_meteo UNION ALL "
        f"SELECT code_insee, time - 366, wind_speed_10m_mean, precipitation_sum, {ANNEE - 1} FROM fx_meteo"),
    "a6_union_forecasts": (
        q_union_forecasts,
        "SELECT p.*, c.code_insee_reg AS region FROM fx_meteo_prev p JOIN fx_communes c ON c.code_insee = p.code_insee"),
    "a7_register_views": (
        lambda s, sf: q_register_and_count(s, sf, False),
        "SELECT * FROM (VALUES ('v_communes', TRUE), ('v_calendrier', TRUE), ('v_absente', FALSE)) t(view, registered)"),
    "a8_table_counts": (
        lambda s, sf: q_register_and_count(s, sf, True),
        "SELECT 'v_communes' AS view, count(*) AS rows FROM fx_communes UNION ALL "
        "SELECT 'v_calendrier', count(*) FROM fx_calendrier UNION ALL SELECT 'v_jamais_creee', CAST(NULL AS BIGINT)"),
    "a9_master_view": (
        lambda s, sf: _r6(TB.master_view(enriched(s, sf), adm(s, sf))),
        f"""WITH {ENRICHI_CTE}
SELECT e.insee_com, e.nom_commune, e.c_maj, e.c_ift_hbc, e.c_ift_h, e.c_maj AS c_maj_2, e.ift_t, e.ift_t_hbc, e.ift_h,
 e.iftbc, e.p_bio, e.p_sau, a.nom_commune AS nom_commune_2, a.code_insee_dep, a.code_insee_reg,
 round(a.latitude, 6) AS latitude, round(a.longitude, 6) AS longitude
FROM enr e LEFT JOIN adm a ON e.insee_com = a.code_insee"""),
    "a10_read_landed_weather": (q_landed, "SELECT code_insee, time, precipitation_sum, wind_speed_10m_mean FROM fx_meteo"),
    "a11_request_plan": (
        lambda s, sf: W.request_plan(adm(s, sf), 100),
        f"""WITH {ADM_CTE},
n AS (SELECT code_insee, round(latitude, 4) AS lat, round(longitude, 4) AS lon,
  row_number() OVER (ORDER BY code_insee) AS rn FROM adm),
b AS (SELECT n.*, CAST(floor((rn - 1) / 100) AS BIGINT) AS batch FROM n)
SELECT batch, count(*) AS n_communes, string_agg(code_insee, ',' ORDER BY rn) AS codes,
 string_agg(CAST(lat AS VARCHAR), ',' ORDER BY rn) AS latitude, string_agg(CAST(lon AS VARCHAR), ',' ORDER BY rn) AS longitude
FROM b GROUP BY batch"""),
    "a11_window_request_plan": (
        lambda s, sf: W.window_request_plan(M.sampling_points(clean(s, sf)), 100),
        f"""WITH {SQL_CLEAN},
w AS (SELECT DISTINCT code_insee, latitude, longitude, debut_prelevement - 15 AS start_date, fin_prelevement + 15 AS end_date
 FROM clean WHERE latitude IS NOT NULL),
n AS (SELECT w.*, row_number() OVER (PARTITION BY start_date, end_date
  ORDER BY code_insee NULLS FIRST, latitude, longitude) AS rn FROM w),
b AS (SELECT *, CAST(floor((rn - 1) / 100) AS BIGINT) AS batch FROM n)
SELECT start_date, end_date, batch, count(*) AS n_communes, string_agg(code_insee, ',' ORDER BY rn) AS codes,
 string_agg(CAST(round(latitude, 4) AS VARCHAR), ',' ORDER BY rn) AS latitude,
 string_agg(CAST(round(longitude, 4) AS VARCHAR), ',' ORDER BY rn) AS longitude
FROM b GROUP BY start_date, end_date, batch"""),
    "a12_upsert_risk": (
        q_upsert,
        f"""WITH risk AS ({risk_sql(ANNEE)}),
reg AS (SELECT insee_com FROM fx_ift WHERE ift_t IS NOT NULL AND code_insee_reg = '11')
SELECT risk.* REPLACE (CASE WHEN insee_com IN (SELECT insee_com FROM reg) THEN {level('risque_brut', (0.5, 1.0, 2.0))}
 ELSE risque_0_4 END AS risque_0_4), {ANNEE} AS annee, substr(insee_com, 1, 2) AS dep FROM risk"""),
    "j2_upsert_recomputed_days": (
        q_upsert_days,
        f"""WITH risk AS ({risk_sql(ANNEE)}),
late AS (SELECT DISTINCT time AS d FROM fx_meteo WHERE day(time) > 20)
SELECT risk.* REPLACE (CASE WHEN date IN (SELECT d FROM late) THEN {level('risque_brut', (0.5, 1.0, 2.0))}
 ELSE risque_0_4 END AS risque_0_4), {ANNEE} AS annee, substr(insee_com, 1, 2) AS dep FROM risk"""),
    "a13_assert_unique_risk": (
        lambda s, sf: TB.assert_unique(risk_year(inputs(s, sf)), ["insee_com", "date"]),
        f"WITH risk AS ({risk_sql(ANNEE)})\nSELECT insee_com, date, count(*) AS n FROM risk GROUP BY insee_com, date HAVING count(*) > 1"),
    "a13_assert_unique_ift_csv": (
        lambda s, sf: TB.assert_unique(fixture(s, sf, "fx_ift_csv"), ["insee_com"]),
        "SELECT insee_com, count(*) AS n FROM fx_ift_csv GROUP BY insee_com HAVING count(*) > 1"),
    "a14_replace_forecasts": (
        q_replace_forecasts,
        risk_sql(ANNEE, days_sql="SELECT DISTINCT time AS day FROM fx_meteo_prev", weather="fx_meteo_prev", neutral=False)),
    "a15_save_weather": (
        q_save_weather,
        "SELECT count(*) AS rows, min(time) AS first_day, max(time) AS last_day FROM fx_meteo"),
    "a16_cached": (q_cached, "SELECT * FROM fx_meteo_jour"),
    "a17_build_static": (
        lambda s, sf: _r6(s.read.parquet(ST.build_static(
            s, shared_path(s, "static"), fixture(s, sf, "fx_ift_csv"), fixture(s, sf, "fx_nomenclature"),
            adm(s, sf), fixture(s, sf, "fx_calendrier"))["ift_communes_enrichi"])),
        f"WITH {ENRICHI_CTE}\nSELECT {_R6} FROM enr"),
    "c1_enrich_ift": (lambda s, sf: _r6(enriched(s, sf)), f"WITH {ENRICHI_CTE}\nSELECT {_R6} FROM enr"),
    "e14_build_ift": (lambda s, sf: built_ift(s, sf)[0], f"WITH {IFT_BUILD_CTE}\nSELECT * FROM ift"),
    "d31_dedupe_keep_first": (
        lambda s, sf: built_ift(s, sf)[1],
        "SELECT count(*) - count(DISTINCT insee_com) AS doublons_supprimes FROM fx_ift_csv"),
    "b11_label_of_code": (
        lambda s, sf: built_ift(s, sf)[0].select("insee_com", "c_maj_depuis_code", "c_ift_hbc_depuis_code",
                                                 "c_ift_h_depuis_code"),
        f"WITH {IFT_BUILD_CTE}\nSELECT insee_com, c_maj_depuis_code, c_ift_hbc_depuis_code, c_ift_h_depuis_code FROM ift"),
    "e13_build_calendar": (
        lambda s, sf: build_calendar(
            fixture(s, sf, "fx_calendrier_brut").select(
                "departement_code", "culture", F.col("debut_txt_date").alias("debut_de_periode"),
                F.col("fin_txt_date").alias("fin_de_periode"), F.col("herbicides_txt").alias("herbicides"),
                F.col("fongicides_txt").alias("fongicides"), F.col("insecticides_txt").alias("insecticides"),
                "commentaires"),
            ANNEE, fixture(s, sf, "fx_calendrier_idf")),
        f"""WITH mo(m, n) AS (VALUES ('janvier', 1), ('février', 2), ('mars', 3), ('avril', 4), ('mai', 5), ('juin', 6),
 ('juillet', 7), ('août', 8), ('septembre', 9), ('octobre', 10), ('novembre', 11), ('décembre', 12))
SELECT departement_code, culture, make_date({ANNEE}, month(debut_txt_date), day(debut_txt_date)) AS debut_de_periode,
 make_date({ANNEE}, month(fin_txt_date), day(fin_txt_date)) AS fin_de_periode, lower(herbicides_txt) = 'oui' AS herbicides,
 lower(fongicides_txt) = 'oui' AS fongicides, lower(insecticides_txt) = 'oui' AS insecticides, commentaires
FROM fx_calendrier_brut
UNION ALL
SELECT i.departement_code, i.culture, make_date({ANNEE}, mo.n, 1), last_day(make_date({ANNEE}, mo.n, 1)),
 contains(i.type, 'Herbicides'), contains(i.type, 'Fongicides'), contains(i.type, 'Insecticides'), CAST(NULL AS VARCHAR)
FROM fx_calendrier_idf i LEFT JOIN mo ON mo.m = lower(i.periode)"""),
    "e10_merge_history": (
        lambda s, sf: W.merge_history(fixture(s, sf, "fx_meteo_era5"), fixture(s, sf, "fx_meteo_archive"), TODAY, ANNEE),
        f"WITH {MERGED_CTE}\nSELECT * FROM mw"),
    "j1_ingest_landed_weather": (
        q_ingest,
        """WITH l AS (
 SELECT code_insee, time, precipitation_sum, wind_speed_10m_mean, CAST(1 AS BIGINT) AS fetched_at FROM fx_meteo WHERE day(time) <= 20
 UNION ALL SELECT code_insee, time, precipitation_sum, wind_speed_10m_mean, CAST(2 AS BIGINT) FROM fx_meteo_archive)
SELECT * EXCLUDE (rn) FROM (SELECT l.*, row_number() OVER (PARTITION BY code_insee, time ORDER BY fetched_at DESC) AS rn FROM l)
WHERE rn = 1"""),
    "j3_weather_changes": (
        lambda s, sf: weather_changes(stored_weather(s, sf), W.merge_history(
            fixture(s, sf, "fx_meteo_era5"), fixture(s, sf, "fx_meteo_archive"), TODAY, ANNEE)),
        f"WITH {REPAIRED_CTE}\nSELECT code_insee, time FROM changed"),
    "j3_late_weather_repair": (
        lambda s, sf: late_weather_repair(stored_inputs(s, sf), fixture(s, sf, "fx_meteo_era5"),
                                          fixture(s, sf, "fx_meteo_archive"), TODAY),
        f"""WITH {REPAIRED_CTE}, risk AS ({risk_sql(ANNEE, weather="up")})
SELECT risk.* FROM risk WHERE EXISTS (SELECT 1 FROM changed c WHERE c.code_insee = risk.insee_com AND c.time = risk.date)
 OR date IN (SELECT time FROM changed EXCEPT SELECT time FROM st)"""),
    "a17_build_static_full": (q_static_full, _static_full_sql()),
    "g1_sorted_risk_table": (
        q_sorted_table, "SELECT code_insee AS insee_com, CAST(NULL AS DATE) AS date FROM fx_communes WHERE FALSE"),
    # the repaired table is the year computed anew from the repaired weather
    "j3_repair_written": (
        q_repair_written,
        f"WITH {REPAIRED_CTE}, risk AS ({risk_sql(ANNEE, weather='up')})\n"
        f"SELECT *, {ANNEE} AS annee, substr(insee_com, 1, 2) AS dep FROM risk"),
    "j3_repaired_weather": (q_repaired_weather, f"WITH {REPAIRED_CTE}\nSELECT * FROM up"),
}
