"""Shared SQL fragments for the DuckDB oracles (plain ANSI text)."""

from __future__ import annotations

from driftcast.config import CROP_MAP, REGION_CODES


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def values_cte(name: str, cols: tuple[str, str], pairs) -> str:
    rows = ", ".join(f"({_q(a)}, {_q(b)})" for a, b in pairs)
    return f"{name}({cols[0]}, {cols[1]}) AS (VALUES {rows})"


CROP_MAP_CTE = values_cte("cmap", ("src", "dst"), CROP_MAP.items())
REGION_CTE = values_cte("regmap", ("nom", "code"), REGION_CODES.items())

INF = "CAST('Infinity' AS DOUBLE)"
NINF = "CAST('-Infinity' AS DOUBLE)"
NAN = "CAST('NaN' AS DOUBLE)"
ZERO = "CAST(0 AS DOUBLE)"


def contribution(nb: str, ift: str, act: str) -> str:
    """Rule R4 as a CASE, division by zero written out (IEEE values)."""
    return (f"CASE WHEN {nb} IS NULL AND {ift} = 0 THEN {ZERO} "
            f"WHEN {ift} IS NULL THEN {ZERO} "
            f"WHEN {nb} IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN {act} THEN (CASE WHEN {nb} = 0 THEN (CASE WHEN {ift} > 0 THEN {INF} "
            f"WHEN {ift} < 0 THEN {NINF} ELSE {NAN} END) ELSE {ift} / {nb} END) "
            f"ELSE {ZERO} END")


def level(x: str, q=(1, 2, 4)) -> str:
    return (f"CASE WHEN {x} IS NULL THEN CAST(NULL AS INTEGER) WHEN {x} = 0 THEN 0 "
            f"WHEN {x} <= {q[0]} THEN 1 WHEN {x} <= {q[1]} THEN 2 WHEN {x} <= {q[2]} THEN 3 ELSE 4 END")


def weather_cols(w: str = "wind_speed_10m_mean", r: str = "precipitation_sum") -> str:
    return (f"CASE WHEN {r} > 2 OR {w} >= 11 THEN 0 WHEN {w} <= 5 THEN 2 ELSE 1 END AS indicateur_meteo, "
            f"{w} >= 19 AS interdiction_pulv, {w} >= 11 AS traitement_deconseille, "
            f"{r} > 2 AS pluie_limitante, {w} < 11 AS risque_dispersion")


def risk_sql(annee: int, ndays: int | None = None, days_sql: str | None = None,
             weather: str = "fx_meteo", neutral: bool = True, region_code: str | None = None,
             extra_where: str = "", extra_ctes: str | None = None) -> str:
    """Oracle of E2–E6 for the given days (whole year by default)."""
    if days_sql is None:
        ndays = ndays or (366 if annee % 4 == 0 else 365)
        days_sql = (f"SELECT CAST(DATE '{annee}-01-01' + CAST(i AS INTEGER) AS DATE) AS day "
                    f"FROM range({ndays}) t(i)")
    reg = f" AND i.code_insee_reg = '{region_code}'" if region_code else ""
    cfgs = ("maj", "hbc", "h")
    nbj = "\n".join(
        f" LEFT JOIN nb nd_{c} ON nd_{c}.dep = i.dep AND nd_{c}.culture = i.cul_{c}"
        f" LEFT JOIN nbreg nr_{c} ON nr_{c}.reg = i.reg AND nr_{c}.culture = i.cul_{c}"
        for c in cfgs)
    nbsel = ", ".join(f"coalesce(CAST(nd_{c}.nb_{c} AS DOUBLE), nr_{c}.nb_{c}) AS nb_{c}" for c in cfgs)
    acts = ", ".join(
        f"(EXISTS (SELECT 1 FROM act a WHERE a.cfg = '{c}' AND a.dep = b.dep AND a.culture = b.cul_{c} AND a.day = b.day)"
        f" OR EXISTS (SELECT 1 FROM actreg r WHERE r.cfg = '{c}' AND r.reg = b.reg AND r.culture = b.cul_{c} AND r.day = b.day)) AS act_{c}"
        for c in cfgs)
    contribs = ", ".join(f"{contribution(f'nb_{c}', f'ift_{c}', f'act_{c}')} AS j_{c}" for c in cfgs)
    cover_join = (" LEFT JOIN cover cv ON cv.day = t.day" if neutral else "")
    cov = "cv.day IS NOT NULL" if neutral else "TRUE"
    pre = f"{extra_ctes},\n" if extra_ctes else ""
    return f"""
WITH {pre}{CROP_MAP_CTE},
ift AS (
 SELECT i.insee_com, i.code_insee_dep AS dep, i.code_insee_reg AS reg,
  i.ift_t_hbc AS ift_maj, i.ift_hh_hbc AS ift_hbc, i.ift_h AS ift_h,
  m1.dst AS cul_maj, m2.dst AS cul_hbc, m3.dst AS cul_h
 FROM fx_ift i LEFT JOIN cmap m1 ON i.c_maj = m1.src LEFT JOIN cmap m2 ON i.c_ift_hbc = m2.src
  LEFT JOIN cmap m3 ON i.c_ift_h = m3.src
 WHERE i.ift_t IS NOT NULL{reg}),
cal AS (
 SELECT CAST(departement_code AS STRING) AS dep, culture,
  make_date({annee}, month(debut_de_periode), day(debut_de_periode)) AS d0,
  make_date({annee}, month(fin_de_periode), day(fin_de_periode)) AS d1,
  herbicides, fongicides, insecticides
 FROM fx_calendrier),
nb AS (
 SELECT dep, culture, count(*) AS nb_maj,
  count(*) FILTER (WHERE fongicides OR insecticides) AS nb_hbc,
  count(*) FILTER (WHERE herbicides) AS nb_h
 FROM cal GROUP BY dep, culture),
bridge AS (SELECT DISTINCT dep, reg FROM ift),
nbreg AS (
 SELECT b.reg, n.culture, avg(n.nb_maj) AS nb_maj, avg(n.nb_hbc) AS nb_hbc, avg(n.nb_h) AS nb_h
 FROM nb n JOIN bridge b ON n.dep = b.dep GROUP BY b.reg, n.culture),
days AS ({days_sql}),
act AS (
 SELECT DISTINCT 'maj' AS cfg, c.dep, c.culture, d.day FROM cal c JOIN days d ON d.day BETWEEN c.d0 AND c.d1
 UNION ALL
 SELECT DISTINCT 'hbc' AS cfg, c.dep, c.culture, d.day FROM cal c JOIN days d ON d.day BETWEEN c.d0 AND c.d1
  WHERE c.fongicides OR c.insecticides
 UNION ALL
 SELECT DISTINCT 'h' AS cfg, c.dep, c.culture, d.day FROM cal c JOIN days d ON d.day BETWEEN c.d0 AND c.d1
  WHERE c.herbicides),
actreg AS (
 SELECT DISTINCT a.cfg, b.reg, a.culture, a.day FROM act a JOIN bridge b ON a.dep = b.dep
 WHERE b.reg IS NOT NULL),
cover AS (SELECT DISTINCT time AS day FROM {weather}),
w AS (SELECT code_insee, time, {weather_cols()}, wind_speed_10m_mean, precipitation_sum FROM {weather}),
base AS (
 SELECT i.insee_com, i.dep, i.reg, i.cul_maj, i.cul_hbc, i.cul_h, i.ift_maj, i.ift_hbc, i.ift_h, {nbsel},
  coalesce(i.cul_hbc <> i.cul_maj, TRUE) AS hd, coalesce(i.cul_h <> i.cul_maj, TRUE) AS h2
 FROM ift i
{nbj}),
b AS (SELECT base.*, days.day FROM base, days),
a2 AS (SELECT b.*, {acts} FROM b),
c2 AS (SELECT a2.*, {contribs} FROM a2),
t AS (
 SELECT insee_com, day,
  CASE WHEN j_maj IS NOT NULL OR (hd AND j_hbc IS NOT NULL) OR (h2 AND j_h IS NOT NULL)
   THEN coalesce(j_maj, 0) + (CASE WHEN hd THEN coalesce(j_hbc, 0) ELSE 0 END)
        + (CASE WHEN h2 THEN coalesce(j_h, 0) ELSE 0 END) END AS total
 FROM c2),
r AS (
 SELECT t.insee_com, t.day AS date, t.total AS ift_journalier_total,
  CASE WHEN {cov} THEN w.indicateur_meteo ELSE 1 END AS indicateur_meteo,
  CASE WHEN {cov} THEN w.interdiction_pulv ELSE FALSE END AS interdiction_pulv,
  CASE WHEN {cov} THEN w.traitement_deconseille ELSE FALSE END AS traitement_deconseille,
  CASE WHEN {cov} THEN w.pluie_limitante ELSE FALSE END AS pluie_limitante,
  CASE WHEN {cov} THEN w.risque_dispersion ELSE TRUE END AS risque_dispersion,
  CASE WHEN {cov} THEN w.wind_speed_10m_mean END AS wind_speed_10m_mean,
  CASE WHEN {cov} THEN w.precipitation_sum END AS precipitation_sum
 FROM t LEFT JOIN w ON w.code_insee = t.insee_com AND w.time = t.day{cover_join}),
rr AS (SELECT r.*, CASE WHEN isnan(ift_journalier_total * indicateur_meteo) THEN {NAN}
  ELSE ift_journalier_total * indicateur_meteo END AS risque_brut FROM r)
SELECT insee_com, date, ift_journalier_total, indicateur_meteo, interdiction_pulv,
 traitement_deconseille, pluie_limitante, risque_dispersion, wind_speed_10m_mean,
 precipitation_sum, risque_brut, {level('risque_brut')} AS risque_0_4
FROM rr {extra_where}"""
