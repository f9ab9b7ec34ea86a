"""More risk-family queries: E1, D1/F1, E3, E4, E7/D27, E18–E21, D23, D24,
D28, J2 (all over whole fixture tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftcast.fixtures import fixture
from driftcast.functions.aggs import ordered_sum_sql
from driftcast.operators import display as D
from driftcast.operators import risk as R
from driftcast.operators.calendar import period_counts
from driftcast.plans.risk_q import ANNEE, inputs
from driftcast.plans.sqlparts import CROP_MAP_CTE, risk_sql, weather_cols

RISK_CTE = f"risk AS ({risk_sql(ANNEE)})"
IFT_CTE = f"""{CROP_MAP_CTE},
ift AS (
 SELECT i.insee_com, i.code_insee_dep, i.code_insee_reg, i.c_maj, i.ift_t_hbc AS ift_maj_hbc, i.c_ift_hbc,
  i.ift_hh_hbc, i.c_ift_h, i.ift_h, m1.dst AS c_maj_cal, m2.dst AS c_ift_hbc_cal, m3.dst AS c_ift_h_cal
 FROM fx_ift i LEFT JOIN cmap m1 ON i.c_maj = m1.src LEFT JOIN cmap m2 ON i.c_ift_hbc = m2.src
  LEFT JOIN cmap m3 ON i.c_ift_h = m3.src
 WHERE i.ift_t IS NOT NULL)"""
CAL_CTE = f"""cal AS (
 SELECT CAST(departement_code AS STRING) AS departement_code, culture,
  make_date({ANNEE}, month(debut_de_periode), day(debut_de_periode)) AS debut_de_periode,
  make_date({ANNEE}, month(fin_de_periode), day(fin_de_periode)) AS fin_de_periode,
  herbicides, fongicides, insecticides FROM fx_calendrier),
calc AS (
 SELECT cal.*,
  CAST(sum(CASE WHEN herbicides THEN 1 ELSE 0 END) OVER (PARTITION BY departement_code, culture) AS BIGINT) AS nb_periodes_herbicides,
  CAST(sum(CASE WHEN fongicides OR insecticides THEN 1 ELSE 0 END) OVER (PARTITION BY departement_code, culture) AS BIGINT) AS nb_periodes_fongi_insecti,
  count(*) OVER (PARTITION BY departement_code, culture) AS nb_periodes_total FROM cal),
nb AS (SELECT departement_code, culture, max(nb_periodes_total) AS nb_maj, max(nb_periodes_fongi_insecti) AS nb_hbc,
  max(nb_periodes_herbicides) AS nb_h FROM calc GROUP BY departement_code, culture)"""
CROPS_CTE = """crops AS (
 SELECT DISTINCT insee_com, code_insee_dep, c AS culture FROM (
  SELECT insee_com, code_insee_dep, c_maj_cal AS c FROM ift UNION ALL
  SELECT insee_com, code_insee_dep, c_ift_hbc_cal FROM ift UNION ALL
  SELECT insee_com, code_insee_dep, c_ift_h_cal FROM ift) x WHERE c IS NOT NULL)"""


def _risk(s, sf):
    return R.risk_year(inputs(s, sf))


def _recomputed(s, sf):
    """The weather days after the 20th, computed anew."""
    late = fixture(s, sf, "fx_meteo").where(F.dayofmonth("time") > 20)
    return R.risk_days(inputs(s, sf), late.select(F.array_sort(F.collect_set("time"))).scalar(),
                       late.select(F.min("time")).scalar(), late.select(F.max("time")).scalar())


QUERIES = {
    "e1_load_inputs": (
        lambda s, sf: inputs(s, sf).ift,
        f"WITH {IFT_CTE}\nSELECT * FROM ift"),
    "d1_period_counts": (
        lambda s, sf: period_counts(inputs(s, sf).cal),
        f"WITH {CAL_CTE}\nSELECT * FROM calc"),
    "e3_weather_indicator": (
        lambda s, sf: R.weather_indicator(fixture(s, sf, "fx_meteo")),
        f"SELECT *, {weather_cols()} FROM fx_meteo"),
    "e4_neutral_days": (
        lambda s, sf: R.neutral_days(fixture(s, sf, "fx_meteo"), ANNEE),
        f"""WITH days AS (SELECT CAST(DATE '{ANNEE}-01-01' + CAST(i AS INTEGER) AS DATE) AS date FROM range(366) t(i)),
cov AS (SELECT DISTINCT time FROM fx_meteo)
SELECT d.date, cov.time IS NULL AS neutre FROM days d LEFT JOIN cov ON cov.time = d.date"""),
    "e2_daily_ift": (
        lambda s, sf: _risk(s, sf).select("insee_com", "date", "ift_journalier_total"),
        f"WITH {RISK_CTE}\nSELECT insee_com, date, ift_journalier_total FROM risk"),
    "e7_levels_quartiles": (
        lambda s, sf: R.levels_by_quartiles(_risk(s, sf)),
        f"""WITH {RISK_CTE},
q AS (SELECT quantile_cont(risque_brut, 0.25) AS q1, quantile_cont(risque_brut, 0.5) AS q2,
  quantile_cont(risque_brut, 0.75) AS q3 FROM risk WHERE risque_brut > 0 AND NOT isnan(risque_brut))
SELECT risk.* REPLACE (CASE WHEN q.q1 IS NULL THEN 0
  ELSE (CASE WHEN risque_brut IS NULL OR isnan(risque_brut) THEN NULL WHEN risque_brut = 0 THEN 0 WHEN risque_brut <= q.q1 THEN 1
  WHEN risque_brut <= q.q2 THEN 2 WHEN risque_brut <= q.q3 THEN 3 ELSE 4 END) END AS risque_0_4)
FROM risk, q"""),
    "d27_quartile_thresholds": (
        lambda s, sf: R.quartiles(_risk(s, sf)).select(
            *[F.round(F.col("q")[i], 9).alias(n) for i, n in enumerate(("q1", "q2", "q3"))]),
        f"""WITH {RISK_CTE}
SELECT round(quantile_cont(risque_brut, 0.25), 9) AS q1, round(quantile_cont(risque_brut, 0.5), 9) AS q2,
 round(quantile_cont(risque_brut, 0.75), 9) AS q3 FROM risk
WHERE risque_brut > 0 AND NOT isnan(risque_brut)"""),
    "e18_commune_year": (
        lambda s, sf: _risk(s, sf).where(F.col("insee_com") == fixture(s, sf, "fx_ift").where(
            F.col("ift_t").isNotNull()).select(F.min("insee_com")).scalar()),
        f"""WITH {RISK_CTE}
SELECT * FROM risk WHERE insee_com = (SELECT min(insee_com) FROM fx_ift WHERE ift_t IS NOT NULL)"""),
    "e19_ift_split": (
        lambda s, sf: R.ift_split(inputs(s, sf)),
        f"""WITH {IFT_CTE}, {CAL_CTE},
long AS (
 SELECT insee_com, code_insee_dep, 'maj' AS config, c_maj_cal AS culture, coalesce(ift_maj_hbc, 0) AS ift_annuel, TRUE AS inclus FROM ift
 UNION ALL SELECT insee_com, code_insee_dep, 'hbc', c_ift_hbc_cal, coalesce(ift_hh_hbc, 0), coalesce(c_ift_hbc_cal <> c_maj_cal, TRUE) FROM ift
 UNION ALL SELECT insee_com, code_insee_dep, 'h', c_ift_h_cal, coalesce(ift_h, 0), coalesce(c_ift_h_cal <> c_maj_cal, TRUE) FROM ift),
j AS (
 SELECT l.*, CASE WHEN l.culture IS NULL THEN NULL ELSE CAST(coalesce(CASE l.config WHEN 'maj' THEN nb.nb_maj
  WHEN 'hbc' THEN nb.nb_hbc ELSE nb.nb_h END, 0) AS BIGINT) END AS nb_periodes
 FROM long l LEFT JOIN nb ON nb.departement_code = l.code_insee_dep AND nb.culture = l.culture)
SELECT insee_com, config, culture, ift_annuel, nb_periodes,
 CASE WHEN culture IS NULL THEN NULL WHEN nb_periodes > 0 THEN ift_annuel / nb_periodes ELSE CAST(0 AS DOUBLE) END AS ift_par_periode,
 inclus FROM j"""),
    "e20_period_detail": (
        lambda s, sf: R.period_detail(inputs(s, sf)),
        f"""WITH {IFT_CTE}, {CAL_CTE}, {CROPS_CTE},
per AS (
 SELECT c.insee_com, c.code_insee_dep, c.culture, k.debut_de_periode, k.fin_de_periode, k.herbicides, k.fongicides,
  k.insecticides, k.debut_de_periode + 1 AS jour_test
 FROM crops c JOIN cal k ON k.departement_code = c.code_insee_dep AND k.culture = c.culture),
r AS ({risk_sql(ANNEE, days_sql="SELECT DISTINCT debut_de_periode + 1 AS day FROM (SELECT make_date(" + str(ANNEE) + ", month(debut_de_periode), day(debut_de_periode)) AS debut_de_periode FROM fx_calendrier) z")})
SELECT per.*, r.ift_journalier_total FROM per LEFT JOIN r ON r.insee_com = per.insee_com AND r.date = per.jour_test"""),
    "e21_calendar_of_commune": (
        lambda s, sf: R.calendar_of_communes(inputs(s, sf)),
        f"""WITH {IFT_CTE}, {CAL_CTE}, {CROPS_CTE}
SELECT c.insee_com, k.* FROM crops c JOIN calc k ON k.departement_code = c.code_insee_dep AND k.culture = c.culture"""),
    "d23_days_over": (
        lambda s, sf: D.days_over(_risk(s, sf)),
        f"""WITH {RISK_CTE}
SELECT insee_com, count(*) FILTER (WHERE coalesce(risque_0_4, 0) >= 3) AS jours_niveau_3_plus,
 count(*) FILTER (WHERE coalesce(risque_0_4, 0) = 4) AS jours_niveau_4 FROM risk GROUP BY insee_com"""),
    "d24_level_distribution": (
        lambda s, sf: D.level_distribution(_risk(s, sf)),
        f"""WITH {RISK_CTE},
g AS (SELECT insee_com, coalesce(risque_0_4, -1) AS niveau, count(*) AS nb_jours FROM risk GROUP BY insee_com, coalesce(risque_0_4, -1))
SELECT g.*, nb_jours * 100.0 / sum(nb_jours) OVER (PARTITION BY insee_com) AS pct FROM g"""),
    "d24_weather_flag_days": (
        lambda s, sf: D.weather_flag_days(_risk(s, sf)),
        f"""WITH {RISK_CTE}
SELECT insee_com, count(*) FILTER (WHERE interdiction_pulv) AS jours_interdiction,
 count(*) FILTER (WHERE traitement_deconseille) AS jours_deconseille, count(*) FILTER (WHERE pluie_limitante) AS jours_pluie,
 count(*) FILTER (WHERE risque_dispersion) AS jours_dispersion FROM risk GROUP BY insee_com"""),
    "d28_annual_reconstruction": (
        lambda s, sf: D.annual_reconstruction(_risk(s, sf), fixture(s, sf, "fx_ift")),
        f"""WITH {RISK_CTE},
v AS (SELECT insee_com, CASE WHEN NOT isnan(ift_journalier_total) THEN ift_journalier_total END AS x FROM risk),
g AS (SELECT insee_com, max(x) AS ift_j_max, count(*) FILTER (WHERE x > 0) AS jours_positifs,
 count(*) FILTER (WHERE x IS NULL) AS jours_nuls, {ordered_sum_sql('x')} AS somme_ift_j FROM v GROUP BY insee_com)
SELECT g.*, i.ift_t_hbc AS ift_annuel FROM g LEFT JOIN fx_ift i ON i.insee_com = g.insee_com"""),
    "j2_recompute_days": (
        _recomputed,
        risk_sql(ANNEE, days_sql="SELECT DISTINCT time AS day FROM fx_meteo WHERE day(time) > 20")),
}
