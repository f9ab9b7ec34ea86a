"""Inventory items that are steps of larger plans, exposed as their own
queries (C2–C6, C11, D40 count, D41, E5, E6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftcast.fixtures import fixture
from driftcast.functions.aggs import n_unique
from driftcast.functions.columns import level_0_4, region_name
from driftcast.operators import crops as CR
from driftcast.operators.calendar import dep_region_bridge, distinct_active_days
from driftcast.operators.risk import commune_base, daily_contributions, risk_year, spine
from driftcast.functions.columns import year_spine
from driftcast.plans.measures_q import SQL_CLEAN, clean
from driftcast.plans.risk_extra_q import CAL_CTE, IFT_CTE, RISK_CTE
from driftcast.plans.risk_q import ANNEE, inputs
from driftcast.plans.sqlparts import REGION_CTE, risk_sql


def _contrib(s, sf):
    inp = inputs(s, sf)
    return daily_contributions(spine(commune_base(inp), year_spine(ANNEE)), ANNEE)


def _admin(s, sf):
    c = fixture(s, sf, "fx_communes")
    deps = c.select("code_insee_dep", "code_insee_reg").distinct().withColumn(
        "nom_dep", F.concat(F.lit("Département "), F.col("code_insee_dep")))
    regs = c.select("code_insee_reg").distinct().withColumn("nom_reg", region_name("code_insee_reg", "Inconnue"))
    return c.select("code_insee", "nom_commune", "code_insee_dep"), deps, regs



def _contrib_sql() -> str:
    """The risk oracle cut after its contribution step (CTE ``c2``)."""
    full = risk_sql(ANNEE)
    head = full[:full.index("\nt AS (")].rstrip().rstrip(",")
    return head + "\nSELECT insee_com, day AS date, j_maj AS ift_j_maj, j_hbc AS ift_j_hbc, j_h AS ift_j_h FROM c2"

QUERIES = {
    "c2_dep_region_bridge": (
        lambda s, sf: fixture(s, sf, "fx_calendrier").withColumn("departement_code", F.col("departement_code").cast("string"))
        .join(dep_region_bridge(inputs(s, sf).ift), F.col("departement_code") == F.col("code_insee_dep"), "inner")
        .drop("code_insee_dep"),
        """SELECT CAST(c.departement_code AS STRING) AS departement_code, c.culture, c.debut_de_periode, c.fin_de_periode,
 c.herbicides, c.fongicides, c.insecticides, b.code_insee_reg
FROM fx_calendrier c JOIN (SELECT DISTINCT code_insee_dep, code_insee_reg FROM fx_ift WHERE ift_t IS NOT NULL) b
 ON CAST(c.departement_code AS STRING) = b.code_insee_dep"""),
    "c3_active_periods": (
        lambda s, sf: distinct_active_days(inputs(s, sf).cal),
        f"""WITH {CAL_CTE},
days AS (SELECT CAST(DATE '{ANNEE}-01-01' + CAST(i AS INTEGER) AS DATE) AS day FROM range(366) t(i))
SELECT DISTINCT 'maj' AS cfg, c.departement_code, c.culture, d.day AS date FROM cal c JOIN days d ON d.day BETWEEN c.debut_de_periode AND c.fin_de_periode
UNION SELECT 'hbc', c.departement_code, c.culture, d.day FROM cal c JOIN days d ON d.day BETWEEN c.debut_de_periode AND c.fin_de_periode
 WHERE c.fongicides OR c.insecticides
UNION SELECT 'h', c.departement_code, c.culture, d.day FROM cal c JOIN days d ON d.day BETWEEN c.debut_de_periode AND c.fin_de_periode
 WHERE c.herbicides"""),
    "c6_dedup_flags": (
        lambda s, sf: commune_base(inputs(s, sf)).select("insee_com", "hbc_different", "h_different"),
        f"WITH {IFT_CTE}\nSELECT insee_com, coalesce(c_ift_hbc_cal <> c_maj_cal, TRUE) AS hbc_different, "
        "coalesce(c_ift_h_cal <> c_maj_cal, TRUE) AS h_different FROM ift"),
    "c4_contribution_by_config": (
        lambda s, sf: _contrib(s, sf).select("insee_com", "date", "ift_j_maj", "ift_j_hbc", "ift_j_h"),
        _contrib_sql()),
    "c5_side_by_side_total": (
        lambda s, sf: _contrib(s, sf).select("insee_com", "date", "ift_journalier_total"),
        f"WITH {RISK_CTE}\nSELECT insee_com, date, ift_journalier_total FROM risk"),
    "c11_admin_hierarchy": (
        lambda s, sf: CR.admin_hierarchy(*_admin(s, sf)),
        f"""WITH {REGION_CTE},
deps AS (SELECT DISTINCT code_insee_dep, code_insee_reg FROM fx_communes),
d AS (SELECT deps.code_insee_dep, concat('Département ', deps.code_insee_dep) AS nom_dep, deps.code_insee_reg,
  coalesce(r.nom, 'Inconnue') AS nom_reg FROM deps LEFT JOIN regmap r ON r.code = deps.code_insee_reg)
SELECT c.code_insee_dep, c.code_insee, c.nom_commune, d.nom_dep, d.code_insee_reg, d.nom_reg
FROM fx_communes c JOIN d ON d.code_insee_dep = c.code_insee_dep"""),
    "d40_code_count": (
        lambda s, sf: clean(s, sf).agg(n_unique("code_insee").alias("nb_codes"),
                                       F.count_distinct("code_insee").alias("nb_codes_non_nuls"),
                                       F.max(F.col("code_insee").isNull()).alias("code_nul_present")),
        f"""WITH {SQL_CLEAN}
SELECT CAST(count(DISTINCT code_insee) + max(CASE WHEN code_insee IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nb_codes,
 count(DISTINCT code_insee) AS nb_codes_non_nuls, bool_or(code_insee IS NULL) AS code_nul_present FROM clean"""),
    "d41_zone_totals": (
        lambda s, sf: CR.zone_totals(fixture(s, sf, "fx_parcelles"), ["code_insee_dep"], "03"),
        """WITH p AS (SELECT * FROM fx_parcelles WHERE code_insee_dep = '03'),
pc AS (SELECT code_insee_dep, code_group, code_cultu, sum(surf_parc) AS t, count(*) AS n FROM p GROUP BY 1, 2, 3)
SELECT s.code_insee_dep, s.nb_parc_crops, s.SAU_tot_crops, z.SAU_tot, z.nb_parc, z.nb_cult FROM
 (SELECT code_insee_dep, sum(n) AS nb_parc_crops, sum(t) AS SAU_tot_crops FROM pc GROUP BY code_insee_dep) s
 JOIN (SELECT code_insee_dep, sum(surf_parc) AS SAU_tot, count(DISTINCT id_parcel) AS nb_parc, count(DISTINCT code_cultu) AS nb_cult
  FROM p GROUP BY code_insee_dep) z ON z.code_insee_dep = s.code_insee_dep"""),
    "e5_gross_risk": (
        lambda s, sf: risk_year(inputs(s, sf)).select("insee_com", "date", "ift_journalier_total", "indicateur_meteo",
                                                      "risque_brut"),
        f"WITH {RISK_CTE}\nSELECT insee_com, date, ift_journalier_total, indicateur_meteo, risque_brut FROM risk"),
    "e6_level_fixed_thresholds": (
        lambda s, sf: risk_year(inputs(s, sf)).select("insee_com", "date", "risque_brut",
                                                      level_0_4("risque_brut", (1.0, 2.0, 4.0)).alias("risque_0_4")),
        f"WITH {RISK_CTE}\nSELECT insee_com, date, risque_brut, risque_0_4 FROM risk"),
}
