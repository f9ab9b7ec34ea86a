"""Queries of the crop-area family."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftcast.fixtures import fixture
from driftcast.functions.aggs import n_unique_sql as nu
from driftcast.operators import crops as C

Z = ["code_insee", "nom_commune"]


def _p(spark, sf):
    return fixture(spark, sf, "fx_parcelles")


def _cwe(spark, sf):
    return C.communes_with_epci(fixture(spark, sf, "fx_epci"), fixture(spark, sf, "fx_communes_epci"))


def _iwe(spark, sf):
    return C.ift_with_epci(fixture(spark, sf, "fx_ift"), _cwe(spark, sf))


def _rpg_zone(spark, sf):
    return C.top3_crops(_p(spark, sf), Z).select(
        F.col("code_insee").alias("code_insee_rpg"), "code_cultu_1", "SAU_tot")


def _cmp(spark, sf):
    ift = fixture(spark, sf, "fx_ift").select("insee_com", "c_maj", "cod_c_maj")
    z = _rpg_zone(spark, sf)
    return C.ift_right_rpg(ift, z, "insee_com", "code_insee_rpg")


SQL_CWE = """cwe AS (
 SELECT e.nom_officiel AS nom_epci, e.nature, e.code_siren, c.nom_commune, c.code_insee, c.code_postal, c.codes_siren_des_epci
 FROM fx_epci e LEFT JOIN fx_communes_epci c ON e.code_siren = c.codes_siren_des_epci)"""
SQL_IWE = SQL_CWE + """,
iwe AS (SELECT i.*, cwe.nom_epci, cwe.nature, cwe.code_siren, cwe.nom_commune, cwe.code_insee, cwe.code_postal, cwe.codes_siren_des_epci
 FROM fx_ift i LEFT JOIN cwe ON i.insee_com = cwe.code_insee)"""

SQL_TOP3 = f"""WITH a AS (SELECT code_insee, nom_commune, code_cultu, sum(surf_parc) AS SAU_cult FROM fx_parcelles GROUP BY code_insee, nom_commune, code_cultu),
r AS (SELECT a.*, sum(SAU_cult) OVER (PARTITION BY code_insee, nom_commune) AS SAU_tot_z,
  row_number() OVER (PARTITION BY code_insee, nom_commune ORDER BY SAU_cult DESC, code_cultu) AS rk FROM a),
r2 AS (SELECT r.*, SAU_cult / SAU_tot_z * 100 AS pct_SAU FROM r WHERE rk <= 3),
p AS (SELECT code_insee, nom_commune,
  max(CASE WHEN rk = 1 THEN code_cultu END) AS code_cultu_1, max(CASE WHEN rk = 1 THEN SAU_cult END) AS SAU_cult_1, max(CASE WHEN rk = 1 THEN pct_SAU END) AS pct_SAU_1,
  max(CASE WHEN rk = 2 THEN code_cultu END) AS code_cultu_2, max(CASE WHEN rk = 2 THEN SAU_cult END) AS SAU_cult_2, max(CASE WHEN rk = 2 THEN pct_SAU END) AS pct_SAU_2,
  max(CASE WHEN rk = 3 THEN code_cultu END) AS code_cultu_3, max(CASE WHEN rk = 3 THEN SAU_cult END) AS SAU_cult_3, max(CASE WHEN rk = 3 THEN pct_SAU END) AS pct_SAU_3
  FROM r2 GROUP BY code_insee, nom_commune),
s AS (SELECT code_insee, nom_commune, sum(surf_parc) AS SAU_tot, {nu('id_parcel')} AS nb_parc, {nu('code_cultu')} AS nb_cult FROM fx_parcelles GROUP BY code_insee, nom_commune),
m AS (SELECT code_insee, nom_commune, code_cultu AS cult_maj FROM r WHERE rk = 1),
top3 AS (SELECT s.code_insee, s.nom_commune, s.SAU_tot, s.nb_parc, s.nb_cult, m.cult_maj,
  p.code_cultu_1, p.SAU_cult_1, p.pct_SAU_1, p.code_cultu_2, p.SAU_cult_2, p.pct_SAU_2, p.code_cultu_3, p.SAU_cult_3, p.pct_SAU_3
 FROM s JOIN m ON s.code_insee = m.code_insee AND s.nom_commune = m.nom_commune LEFT JOIN p ON s.code_insee = p.code_insee AND s.nom_commune = p.nom_commune)"""

SQL_CMP = SQL_TOP3 + """,
cmp AS (SELECT i.insee_com, i.c_maj, i.cod_c_maj, t.code_insee AS code_insee_rpg, t.code_cultu_1, t.SAU_tot,
  t.code_cultu_1 = i.cod_c_maj AS match_code_majoritaire
 FROM (SELECT insee_com, c_maj, cod_c_maj FROM fx_ift) i RIGHT JOIN top3 t ON i.insee_com = t.code_insee)"""

QUERIES = {
    "d5_commune_parcel_summary": (
        lambda s, sf: C.commune_parcel_summary(_p(s, sf)),
        f"SELECT nom_commune, sum(surf_parc) AS SAU_tot, {nu('id_parcel')} AS nb_parc, {nu('code_cultu')} AS nb_cultures, "
        f"{nu('code_group')} AS nb_groupes_culture FROM fx_parcelles GROUP BY nom_commune"),
    "d6_crop_area_by_zone": (
        lambda s, sf: C.crop_area_by_zone(_p(s, sf), Z),
        "SELECT code_insee, nom_commune, code_group, code_cultu, sum(surf_parc) AS SAU_tot, avg(surf_parc) AS SAU_moy, "
        "count(*) AS nb_parc FROM fx_parcelles GROUP BY code_insee, nom_commune, code_group, code_cultu"),
    "d6_crop_area_by_departement": (
        lambda s, sf: C.crop_area_by_zone(_p(s, sf), ["code_insee_dep"]),
        "SELECT code_insee_dep, code_group, code_cultu, sum(surf_parc) AS SAU_tot, avg(surf_parc) AS SAU_moy, "
        "count(*) AS nb_parc FROM fx_parcelles GROUP BY code_insee_dep, code_group, code_cultu"),
    "d7_zone_summary": (
        lambda s, sf: C.zone_summary(_p(s, sf), Z),
        f"SELECT code_insee, nom_commune, sum(surf_parc) AS SAU_tot, {nu('id_parcel')} AS nb_parc, {nu('code_cultu')} AS nb_cult "
        "FROM fx_parcelles GROUP BY code_insee, nom_commune"),
    "d8_majority_crop_by_area": (
        lambda s, sf: C.majority_crop_by_area(_p(s, sf), Z),
        "WITH a AS (SELECT code_insee, nom_commune, code_cultu, sum(surf_parc) AS v FROM fx_parcelles GROUP BY 1, 2, 3) "
        "SELECT code_insee, nom_commune, code_cultu AS cult_maj FROM (SELECT a.*, row_number() OVER "
        "(PARTITION BY code_insee, nom_commune ORDER BY v DESC, code_cultu) AS rk FROM a) WHERE rk = 1"),
    "d9_majority_crop_by_count": (
        lambda s, sf: C.majority_crop_by_count(_p(s, sf), Z),
        "WITH a AS (SELECT code_insee, nom_commune, code_cultu, count(*) AS n FROM fx_parcelles GROUP BY 1, 2, 3) "
        "SELECT code_insee, nom_commune, code_cultu AS culture_majoritaire, n AS nb_parcelles_culture FROM "
        "(SELECT a.*, row_number() OVER (PARTITION BY code_insee, nom_commune ORDER BY n DESC, code_cultu) AS rk FROM a) WHERE rk = 1"),
    "d10_top3_crops": (
        lambda s, sf: C.top3_crops(_p(s, sf), Z),
        SQL_TOP3 + "\nSELECT * FROM top3"),
    "d11_epci_summary": (
        lambda s, sf: C.epci_summary(_iwe(s, sf)),
        "WITH " + SQL_IWE + f"""
SELECT codes_siren_des_epci, nom_epci, {nu('code_postal')} AS nb_code_postal, {nu('insee_com')} AS nb_communes,
 sum(sau) AS SAU_tot, sum(sau_bio) AS SAU_bio_tot, avg(ift_t_hbc) AS ift_t_hbc_moy, avg(ift_hh_hbc) AS ift_hh_hbc_moy,
 avg(ift_h) AS ift_h_moy FROM iwe GROUP BY codes_siren_des_epci, nom_epci"""),
    "d12_epci_cardinality_check": (
        lambda s, sf: C.epci_cardinality_check(_cwe(s, sf)),
        "WITH " + SQL_CWE + """
SELECT codes_siren_des_epci, count(DISTINCT nom_epci) AS nb_nom_epci, count(DISTINCT code_postal) AS nb_code_postal,
 count(DISTINCT code_insee) AS nb_communes, count(DISTINCT code_siren) AS nb_epci FROM cwe GROUP BY codes_siren_des_epci"""),
    "d13_epci_top3_crops": (
        lambda s, sf: C.epci_top3_crops(_iwe(s, sf)),
        "WITH " + SQL_IWE + """,
g AS (SELECT codes_siren_des_epci, nom_epci, c_maj, cod_c_maj, sum(sau) AS proxy_sau_culture, count(insee_com) AS nb_communes
 FROM iwe GROUP BY codes_siren_des_epci, nom_epci, c_maj, cod_c_maj),
r AS (SELECT g.*, row_number() OVER (PARTITION BY codes_siren_des_epci ORDER BY proxy_sau_culture DESC, cod_c_maj, c_maj) AS rk FROM g)
SELECT codes_siren_des_epci, nom_epci,
 max(CASE WHEN rk = 1 THEN c_maj END) AS c_maj_1, max(CASE WHEN rk = 1 THEN cod_c_maj END) AS cod_c_maj_1, max(CASE WHEN rk = 1 THEN proxy_sau_culture END) AS sau_c_maj_1,
 max(CASE WHEN rk = 2 THEN c_maj END) AS c_maj_2, max(CASE WHEN rk = 2 THEN cod_c_maj END) AS cod_c_maj_2, max(CASE WHEN rk = 2 THEN proxy_sau_culture END) AS sau_c_maj_2,
 max(CASE WHEN rk = 3 THEN c_maj END) AS c_maj_3, max(CASE WHEN rk = 3 THEN cod_c_maj END) AS cod_c_maj_3, max(CASE WHEN rk = 3 THEN proxy_sau_culture END) AS sau_c_maj_3
FROM r WHERE rk <= 3 GROUP BY codes_siren_des_epci, nom_epci"""),
    "c12_epci_link": (
        lambda s, sf: _iwe(s, sf).select("insee_com", "codes_siren_des_epci", "nom_epci", "code_postal"),
        "WITH " + SQL_IWE + "\nSELECT insee_com, codes_siren_des_epci, nom_epci, code_postal FROM iwe"),
    "c13_ift_right_rpg": (
        lambda s, sf: _cmp(s, sf),
        SQL_CMP + "\nSELECT * FROM cmp"),
    "d14_match_metrics": (
        lambda s, sf: C.match_metrics(_cmp(s, sf)),
        SQL_CMP + f"""
SELECT count(*) AS total, count(code_cultu_1) AS avec_rpg,
 CAST(coalesce(sum(CAST(match_code_majoritaire AS INTEGER)), 0) AS BIGINT) AS nb_match,
 avg(CAST(match_code_majoritaire AS DOUBLE)) AS taux_match, count(cod_c_maj) AS avec_ift,
 {nu('cod_c_maj')} AS nb_codes_ift, {nu('code_cultu_1')} AS nb_codes_rpg FROM cmp"""),
    "d15_crosstab": (
        lambda s, sf: C.crosstab_long(_cmp(s, sf)),
        SQL_CMP + """,
c AS (SELECT cod_c_maj, code_cultu_1, count(*) AS n FROM cmp WHERE code_cultu_1 IS NOT NULL GROUP BY cod_c_maj, code_cultu_1)
SELECT c.*, n / sum(n) OVER (PARTITION BY cod_c_maj) * 100 AS pct_ligne FROM c"""),
    "c14_crop_label_join": (
        lambda s, sf: C.crop_label_join(_cmp(s, sf), fixture(s, sf, "fx_nomenclature")),
        SQL_CMP + """
SELECT cmp.*, n.libelle_culture AS lib_cultu_1 FROM cmp LEFT JOIN fx_nomenclature n ON cmp.code_cultu_1 = n.code_culture"""),
    "d16_divergences": (
        lambda s, sf: C.divergences(
            C.crop_label_join(_cmp(s, sf), fixture(s, sf, "fx_nomenclature")).withColumnRenamed(
                "code_insee_rpg", "nom_commune"), "nom_commune"),
        SQL_CMP + """
SELECT cmp.code_insee_rpg AS nom_commune, cmp.cod_c_maj, cmp.code_cultu_1, n.libelle_culture AS lib_cultu_1
FROM cmp LEFT JOIN fx_nomenclature n ON cmp.code_cultu_1 = n.code_culture
WHERE cmp.match_code_majoritaire = FALSE AND cmp.code_cultu_1 IS NOT NULL"""),
    "d17_match_rate_by_crop": (
        lambda s, sf: C.match_rate_by_crop(_cmp(s, sf)),
        SQL_CMP + """
SELECT cod_c_maj, c_maj, count(*) AS nb_communes, round(avg(CAST(match_code_majoritaire AS DOUBLE)), 2) AS taux_match
FROM cmp WHERE code_cultu_1 IS NOT NULL GROUP BY cod_c_maj, c_maj
ORDER BY nb_communes DESC, cod_c_maj NULLS FIRST, c_maj NULLS FIRST LIMIT 30"""),
    "c21_area_check": (
        lambda s, sf: C.area_check(_p(s, sf), Z),
        """WITH a AS (SELECT code_insee, nom_commune, round(sum(surf_parc), 3) AS a FROM fx_parcelles GROUP BY 1, 2),
b0 AS (SELECT code_insee, nom_commune, code_group, code_cultu, sum(surf_parc) AS t FROM fx_parcelles GROUP BY 1, 2, 3, 4),
b AS (SELECT code_insee, nom_commune, round(sum(t), 3) AS b FROM b0 GROUP BY 1, 2)
SELECT bool_and(a.a = b.b) AS all_equal, count(*) AS nb_zones FROM a JOIN b ON a.code_insee = b.code_insee AND a.nom_commune = b.nom_commune"""),
    "d34_commune_parcel_stats": (
        lambda s, sf: C.commune_parcel_stats(_p(s, sf), Z, bio_group="G1"),
        "SELECT code_insee, nom_commune, count(*) AS nb_parcelles, count(DISTINCT code_cultu) AS nb_cultures, "
        "sum(surf_parc) AS surface_totale, avg(CAST(code_group = 'G1' AS DOUBLE)) * 100 AS pct_bio "
        "FROM fx_parcelles GROUP BY code_insee, nom_commune"),
}
