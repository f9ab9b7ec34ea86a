"""Fixture views over the driver's tables (FIXTURES.md §2).

Each fixture is one SELECT whose table references are ``{placeholders}``.
The same text feeds Spark (``spark.sql(text, customer=df, ...)``, no global
view names) and the DuckDB oracles (placeholders replaced by the view
names, bodies put in front of the oracle query as CTEs). The values are
dyadic on purpose so that doubles hash equal in both engines.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

_CROPS9 = ("CASE {e} WHEN 0 THEN 'Blé tendre' WHEN 1 THEN 'Triticale' WHEN 2 THEN 'Maïs' "
           "WHEN 3 THEN 'Vigne' WHEN 4 THEN 'Colza' WHEN 5 THEN 'Soja' WHEN 6 THEN 'Tournesol' "
           "WHEN 7 THEN 'Prairie permanente' WHEN 8 THEN 'Tabac' END")


def _crops(e: str) -> str:
    return _CROPS9.replace("{e}", e)


# name -> SELECT text. Order matters: a fixture may only use earlier ones.
FX: dict[str, str] = {}

FX["fx_communes"] = """
SELECT concat(lpad(CAST(c.c_nationkey+1 AS STRING),2,'0'), lpad(CAST(c.c_custkey AS STRING),6,'0')) AS code_insee,
 upper(c.c_name) AS nom_commune, lpad(CAST(c.c_nationkey+1 AS STRING),2,'0') AS code_insee_dep,
 lpad(CAST(n.n_regionkey+11 AS STRING),2,'0') AS code_insee_reg,
 CAST(200000 + (c.c_custkey*7919)%900000 AS DOUBLE) AS x_l93, CAST(6100000 + (c.c_custkey*104729)%900000 AS DOUBLE) AS y_l93, c.c_custkey AS k
FROM {customer} c JOIN {nation} n ON c.c_nationkey=n.n_nationkey"""

FX["fx_ift"] = f"""
SELECT f.code_insee AS insee_com, substr(f.code_insee,1,2) AS code_insee_dep,
 CASE WHEN f.k%31=0 THEN NULL ELSE f.code_insee_reg END AS code_insee_reg,
 {_crops('f.k%9')} AS c_maj, {_crops('f.k%7')} AS c_ift_hbc, {_crops('f.k%5')} AS c_ift_h,
 CASE WHEN f.k%29=0 THEN NULL ELSE CAST(CAST(round(abs(c.c_acctbal)*100) AS BIGINT)%8192 AS DOUBLE)/1024 END AS ift_t,
 CAST(CAST(round(abs(c.c_acctbal)*100) AS BIGINT)%8192 AS DOUBLE)/1024 AS ift_t_hbc,
 CASE WHEN f.k%17=0 THEN NULL ELSE CAST(f.k%40 AS DOUBLE)/8 END AS ift_hh_hbc,
 CASE WHEN f.k%13=0 THEN CAST(0 AS DOUBLE) ELSE CAST(f.k%24 AS DOUBLE)/8 END AS ift_h,
 CAST(f.k%500 AS DOUBLE) AS sau, CAST(f.k%100 AS DOUBLE) AS sau_bio,
 CAST(f.k%64 AS DOUBLE)/64 AS p_bio, CAST(f.k%32 AS DOUBLE)/32 AS p_sau, CAST(f.k%48 AS DOUBLE)/16 AS iftbc,
 concat('C', CAST(f.k%12 AS STRING)) AS cod_c_maj, concat('C', CAST(f.k%7 AS STRING)) AS cod_c_hbc,
 CASE WHEN f.k%43=0 THEN NULL ELSE concat('C', CAST(f.k%5 AS STRING)) END AS cod_c_h, f.k
FROM {{fx_communes}} f JOIN {{customer}} c ON f.k=c.c_custkey WHERE f.k%23<>0"""

FX["fx_calendrier"] = """
SELECT CAST(1+p_partkey%20 AS INT) AS departement_code, CASE ((p_partkey*7+CAST(floor(p_partkey/20) AS BIGINT)) % 8) WHEN 0 THEN 'Blé tendre' WHEN 1 THEN concat('Céréales d', chr(39), 'hiver') WHEN 2 THEN 'Maïs' WHEN 3 THEN 'Vigne' WHEN 4 THEN 'Colza' WHEN 5 THEN concat('Féverole d', chr(39), 'hiver') WHEN 6 THEN 'Tournesol' WHEN 7 THEN 'Prairies' END AS culture,
 make_date(2023, CAST(1+p_size%12 AS INT), CAST(1+p_partkey%28 AS INT)) AS debut_de_periode,
 make_date(2023, CAST(1+p_size%12 AS INT), CAST(1+p_partkey%28 AS INT)) + CAST(10+p_size AS INT) AS fin_de_periode,
 p_size%3=0 AS herbicides, p_size%4=1 AS fongicides, p_partkey%5=2 AS insecticides
FROM {part}"""

FX["fx_meteo"] = """
SELECT f.code_insee, d.jour AS time,
 CASE WHEN f.k%19=0 THEN NULL ELSE CAST((f.k*31+day(d.jour)*17)%160 AS DOUBLE)/10 END AS wind_speed_10m_mean,
 CASE WHEN (f.k+day(d.jour))%37=0 THEN NULL ELSE CAST((f.k*13+day(d.jour)*7)%40 AS DOUBLE)/16 END AS precipitation_sum
FROM {fx_communes} f CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS jour FROM {events}) d
WHERE f.k%11<>0 AND day(d.jour)%9<>0"""

# Forecast file: the last 7 event days, other numbers, every commune with a
# weather series (no neutral day inside a forecast).
FX["fx_meteo_prev"] = """
SELECT f.code_insee, d.jour AS time,
 CASE WHEN f.k%19=0 THEN NULL ELSE CAST((f.k*7+day(d.jour)*11)%160 AS DOUBLE)/10 END AS wind_speed_10m_mean,
 CAST((f.k*5+day(d.jour)*3)%40 AS DOUBLE)/16 AS precipitation_sum
FROM {fx_communes} f CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS jour FROM {events} WHERE day(CAST(ts AS DATE)) > 23) d
WHERE f.k%11<>0"""

FX["fx_mesures"] = """
SELECT f.code_insee, f.nom_commune, concat('S', CAST(e.event_id%20 AS STRING)) AS substance,
 CAST(e.ts AS DATE) AS debut_prelevement, CAST(e.ts AS DATE)+7 AS fin_prelevement,
 CASE WHEN e.event_id%4=0 THEN '<0.05' WHEN e.event_id%41=0 THEN NULL ELSE CAST(CAST(round(e.value*100) AS BIGINT) AS STRING) END AS concentration_txt,
 CAST(0.05 AS DOUBLE) AS lq_ng_m3, f.x_l93, f.y_l93, e.event_id
FROM {events} e JOIN {fx_communes} f ON e.user_id=f.k"""

FX["fx_parcelles"] = """
SELECT CAST(l_orderkey*10+l_linenumber AS STRING) AS id_parcel, f.code_insee, f.nom_commune, f.code_insee_dep,
 concat('C',CAST(l_partkey%12 AS STRING)) AS code_cultu, concat('G',CAST(l_partkey%4 AS STRING)) AS code_group, l_quantity AS surf_parc
FROM {lineitem} JOIN {fx_communes} f ON l_suppkey=f.k"""

# Communes with their EPCI link, postcode and area (own extension).
FX["fx_communes_epci"] = """
SELECT code_insee, nom_commune, code_insee_dep, code_insee_reg,
 concat(code_insee_dep, lpad(CAST(k%1000 AS STRING),3,'0')) AS code_postal,
 CASE WHEN k%37=0 THEN NULL ELSE concat('E', CAST(k%40 AS STRING)) END AS codes_siren_des_epci,
 CAST(k%5000 AS BIGINT) AS population, CAST((k%300)*64 AS DOUBLE) AS superficie_cadastrale, k
FROM {fx_communes}"""

FX["fx_epci"] = """
SELECT DISTINCT concat('E', CAST(k%40 AS STRING)) AS code_siren,
 concat('EPCI ', CAST(k%40 AS STRING)) AS nom_officiel,
 CASE WHEN k%40 < 4 THEN 'CA' ELSE 'CC' END AS nature
FROM {fx_communes}"""

# Crop nomenclature (annex A): one label per code, from the part table.
FX["fx_nomenclature"] = """
SELECT concat('C', CAST(p_partkey%12 AS STRING)) AS code_culture, min(p_type) AS libelle_culture
FROM {part} GROUP BY concat('C', CAST(p_partkey%12 AS STRING))"""

# Raw measurement sheet (internal names; ``sources.sheets`` puts the sheet
# headers back): short commune codes, missing coordinates and codes, '<'
# values, timestamps.
FX["fx_mesures_brut"] = """
SELECT concat('R', CAST(f.k%6 AS STRING)) AS aasqa, f.nom_commune AS commune,
 CASE WHEN e.event_id%7=0 THEN CAST(f.k%1000 AS STRING) WHEN e.event_id%61=0 THEN NULL ELSE f.code_insee END AS code_insee_txt,
 CASE WHEN e.event_id%53=0 THEN NULL ELSE f.x_l93 END AS xlamb93,
 CASE WHEN e.event_id%53=0 THEN NULL ELSE f.y_l93 END AS ylamb93,
 CAST(CAST(e.ts AS DATE) AS TIMESTAMP) AS debut_ts, CAST(CAST(e.ts AS DATE) + 7 AS TIMESTAMP) AS fin_ts,
 CAST(year(e.ts) AS INT) AS annee, CAST(weekofyear(e.ts) AS INT) AS semaine, CAST(7 AS INT) AS jours,
 'PM10' AS coupure, CAST(1 AS INT) AS prelevement, concat('S', CAST(e.event_id%20 AS STRING)) AS substance,
 CASE WHEN e.event_id%4=0 THEN '<0.05' WHEN e.event_id%41=0 THEN NULL ELSE CAST(CAST(round(e.value*100) AS BIGINT) AS STRING) END AS concentration_txt,
 CAST(e.event_id%4+1 AS DOUBLE)/16 AS lq, e.event_id
FROM {events} e JOIN {fx_communes} f ON e.user_id=f.k"""

# Targeted daily weather (rich variables) for the communes with measurements,
# covering every sampling window +-15 days.
FX["fx_meteo_jour"] = """
SELECT f.code_insee, d.jour AS time,
 CAST((f.k*3+day(d.jour)*5)%64 AS DOUBLE)/4 AS temperature_2m_max,
 CAST((f.k*3+day(d.jour)*5)%64 AS DOUBLE)/4 - 8 AS temperature_2m_min,
 CAST((f.k*3+day(d.jour)*5)%64 AS DOUBLE)/4 - 4 AS temperature_2m_mean,
 CASE WHEN (f.k+day(d.jour))%29=0 THEN NULL ELSE CAST((f.k*13+day(d.jour)*7)%40 AS DOUBLE)/16 END AS precipitation_sum,
 CAST((f.k*31+day(d.jour)*17)%160 AS DOUBLE)/8 AS wind_speed_10m_max,
 CAST((f.k*31+day(d.jour)*17)%160 AS DOUBLE)/16 AS wind_speed_10m_mean,
 CAST(50+(f.k+day(d.jour))%50 AS DOUBLE) AS relative_humidity_2m_max,
 CAST(20+(f.k+day(d.jour))%30 AS DOUBLE) AS relative_humidity_2m_min,
 CAST(35+(f.k+day(d.jour))%40 AS DOUBLE) AS relative_humidity_2m_mean,
 CAST(((f.k+day(d.jour))%12)*3600 AS DOUBLE) AS sunshine_duration
FROM {fx_communes} f JOIN (SELECT DISTINCT user_id FROM {events}) u ON u.user_id=f.k
CROSS JOIN (SELECT DISTINCT CAST(e.ts AS DATE) - 25 + o.p_size AS jour FROM {events} e
 CROSS JOIN (SELECT DISTINCT p_size FROM {part}) o) d"""

# Raw IFT CSV: file order ``id``; some communes appear twice (the second
# copy must be dropped, first in file order wins).
FX["fx_ift_csv"] = """
SELECT CAST(k*2 AS BIGINT) AS id, insee_com, sau, sau_bio, p_bio, CAST(k%16 AS DOUBLE)/16 AS p_bc, p_sau, c_maj, c_ift_hbc, c_ift_h,
 cod_c_maj, cod_c_hbc, cod_c_h, ift_t, ift_t_hbc, ift_h, CAST(k%40 AS DOUBLE)/4 AS ift_t_hh, ift_hh_hbc, iftbc
FROM {fx_ift}
UNION ALL
SELECT CAST(k*2+1 AS BIGINT) AS id, insee_com, sau + 1, sau_bio, p_bio, CAST(k%16 AS DOUBLE)/16, p_sau, c_maj, c_ift_hbc, c_ift_h,
 cod_c_maj, cod_c_hbc, cod_c_h, ift_t, ift_t_hbc, ift_h, CAST(k%40 AS DOUBLE)/4, ift_hh_hbc, iftbc
FROM {fx_ift} WHERE k%10=0"""

# Raw calendar sheet: text flags in mixed case, a comment column.
FX["fx_calendrier_brut"] = """
SELECT departement_code, culture, debut_de_periode AS debut_txt_date, fin_de_periode AS fin_txt_date,
 CASE WHEN herbicides THEN 'Oui' ELSE 'non' END AS herbicides_txt,
 CASE WHEN fongicides THEN 'OUI' ELSE 'Non' END AS fongicides_txt,
 CASE WHEN insecticides THEN 'oui' WHEN departement_code%7=0 THEN NULL ELSE 'NON' END AS insecticides_txt,
 CASE WHEN departement_code%5=0 THEN 'période indicative' END AS commentaires
FROM {fx_calendrier}"""

# Île-de-France calendar (';' CSV in the reference): one row per month.
FX["fx_calendrier_idf"] = """
SELECT CAST(75 + p_partkey%4 AS INT) AS departement_code,
 CASE p_partkey%3 WHEN 0 THEN 'Blé tendre' WHEN 1 THEN 'Maïs' ELSE 'Colza' END AS culture,
 CASE p_size%12 WHEN 0 THEN 'Janvier' WHEN 1 THEN 'février' WHEN 2 THEN 'MARS' WHEN 3 THEN 'avril' WHEN 4 THEN 'Mai'
  WHEN 5 THEN 'juin' WHEN 6 THEN 'Juillet' WHEN 7 THEN 'août' WHEN 8 THEN 'septembre' WHEN 9 THEN 'Octobre'
  WHEN 10 THEN 'novembre' ELSE 'décembre' END AS periode,
 CASE p_partkey%4 WHEN 0 THEN 'Herbicides' WHEN 1 THEN 'Fongicides et Insecticides' WHEN 2 THEN 'herbicides, Fongicides'
  ELSE 'Insecticides' END AS type
FROM {part}"""

# ERA5-like history with a lag: rain unknown after the 26th (to be cut).
FX["fx_meteo_era5"] = """
SELECT code_insee, time, wind_speed_10m_mean,
 CASE WHEN day(time) > 26 THEN NULL ELSE precipitation_sum END AS precipitation_sum
FROM {fx_meteo}"""

# Remote archive covering the last days for every commune.
FX["fx_meteo_archive"] = """
SELECT f.code_insee, d.jour AS time,
 CAST((f.k*29+day(d.jour)*3)%160 AS DOUBLE)/10 AS wind_speed_10m_mean,
 CAST((f.k*11+day(d.jour)*5)%40 AS DOUBLE)/16 AS precipitation_sum
FROM {fx_communes} f CROSS JOIN (SELECT DISTINCT CAST(ts AS DATE) AS jour FROM {events} WHERE day(CAST(ts AS DATE)) > 19) d"""

# Square commune outlines (half side 2048 m around the planar point; some
# communes have no outline) and square parcels scattered around their
# commune (some straddle the outline). Only numbers here: rings are built
# from them (``operators.geo``).
FX["fx_communes_geo"] = """
SELECT code_insee, x_l93, y_l93, CASE WHEN k%17=0 THEN CAST(0 AS DOUBLE) ELSE CAST(2048 AS DOUBLE) END AS half, k
FROM {fx_communes}"""

FX["fx_parcelles_geo"] = """
SELECT CAST(l_orderkey*10+l_linenumber AS STRING) AS id_parcel, f.code_insee AS code_insee_source,
 f.x_l93 + CAST((l_orderkey*37+l_linenumber*101)%4200 AS DOUBLE) - 2100 AS cx,
 f.y_l93 + CAST((l_orderkey*53+l_linenumber*67)%4200 AS DOUBLE) - 2100 AS cy,
 CAST(16*(1+l_linenumber) AS DOUBLE) AS half, concat('C',CAST(l_partkey%12 AS STRING)) AS code_cultu, l_quantity AS surf_parc
FROM {lineitem} JOIN {fx_communes} f ON l_suppkey=f.k"""

# Regular 0.25 degree weather grid (values carried, no arithmetic).
FX["fx_grille"] = """
SELECT CAST(p_partkey%64 AS INT) AS gi, CAST(floor(p_partkey/64) AS INT) AS gj,
 -6.0 + CAST(p_partkey%64 AS DOUBLE)*0.25 AS lon, 40.0 + CAST(floor(p_partkey/64) AS DOUBLE)*0.25 AS lat,
 p_retailprice AS valeur
FROM {part}"""

# Irregular weather stations: planar points spread like the communes.
FX["fx_stations"] = """
SELECT concat('ST', CAST(s_suppkey AS STRING)) AS station, CAST(150000 + (s_suppkey*104723)%1000000 AS DOUBLE) AS x,
 CAST(6050000 + (s_suppkey*7907)%1000000 AS DOUBLE) AS y, CAST(s_suppkey%64 AS DOUBLE)/4 AS valeur
FROM {supplier}"""

_PLACEHOLDER = re.compile(r"(?<!\{)\{([a-z_0-9]+)\}(?!\})")


def deps_of(text: str) -> list[str]:
    return list(dict.fromkeys(_PLACEHOLDER.findall(text)))


def _resolve(text: str) -> str:
    """Placeholders -> plain view names (the DuckDB form)."""
    return _PLACEHOLDER.sub(lambda m: m.group(1), text)


def base_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# (sf_dir, name) -> Parquet path of a stored copy (see ``materialize``)
_STORED: dict[tuple[str, str], str] = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Spark DataFrame of a fixture view (or a base table); a stored
    copy when one was materialized for this scale factor."""
    key = (sf_dir.rstrip("/"), name)
    if key in _STORED:
        return spark.read.parquet(_STORED[key])
    return _fixture_cached(spark, key[0], name)


def materialize(spark: SparkSession, sf_dir: str, out_dir: str, names=None) -> dict[str, str]:
    """Store fixture views as Parquet tables (the reference likewise reads
    the tables its static ETL wrote) and serve them from there afterwards."""
    sf = sf_dir.rstrip("/")
    done = {}
    for name in (names or list(FX)):
        path = f"{out_dir.rstrip('/')}/{name}"
        _fixture_cached(spark, sf, name).write.mode("overwrite").parquet(path)
        _STORED[(sf, name)] = path
        done[name] = path
    return done


def _event_days(spark, sf_dir, min_day: int = 0):
    """Sorted distinct event days (at most one per day of the data) from the
    ``min_day``-th day of the month on, as a scalar subquery array."""
    from pyspark.sql import functions as F
    d = F.to_date("ts")
    return (fixture(spark, sf_dir, "events").where(F.dayofmonth(d) > min_day)
            .select(F.array_sort(F.collect_set(d))).scalar())


def _spark_meteo(spark, sf_dir):
    from pyspark.sql import functions as F
    f = fixture(spark, sf_dir, "fx_communes").where("k % 11 <> 0")
    # the commune table is a few small files, so a few tasks would explode it
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = f.select("code_insee", "k").repartition(n, "code_insee").select(
        "code_insee", "k", F.explode(_event_days(spark, sf_dir)).alias("jour")).where("day(jour) % 9 <> 0")
    return d.select("code_insee", F.col("jour").alias("time"), F.expr(
        "CASE WHEN k%19=0 THEN NULL ELSE CAST((k*31+day(jour)*17)%160 AS DOUBLE)/10 END").alias("wind_speed_10m_mean"),
        F.expr("CASE WHEN (k+day(jour))%37=0 THEN NULL ELSE CAST((k*13+day(jour)*7)%40 AS DOUBLE)/16 END")
        .alias("precipitation_sum"))


def _spark_meteo_prev(spark, sf_dir):
    from pyspark.sql import functions as F
    f = fixture(spark, sf_dir, "fx_communes").where("k % 11 <> 0")
    d = f.select("code_insee", "k", F.explode(_event_days(spark, sf_dir, 23)).alias("jour"))
    return d.select("code_insee", F.col("jour").alias("time"), F.expr(
        "CASE WHEN k%19=0 THEN NULL ELSE CAST((k*7+day(jour)*11)%160 AS DOUBLE)/10 END").alias("wind_speed_10m_mean"),
        F.expr("CAST((k*5+day(jour)*3)%40 AS DOUBLE)/16").alias("precipitation_sum"))


def _spark_meteo_archive(spark, sf_dir):
    from pyspark.sql import functions as F
    f = fixture(spark, sf_dir, "fx_communes")
    d = f.select("code_insee", "k", F.explode(_event_days(spark, sf_dir, 19)).alias("jour"))
    return d.select("code_insee", F.col("jour").alias("time"),
                    F.expr("CAST((k*29+day(jour)*3)%160 AS DOUBLE)/10").alias("wind_speed_10m_mean"),
                    F.expr("CAST((k*11+day(jour)*5)%40 AS DOUBLE)/16").alias("precipitation_sum"))


def _spark_meteo_jour(spark, sf_dir):
    from pyspark.sql import functions as F
    ev = fixture(spark, sf_dir, "events").agg(F.collect_set(F.to_date("ts")).alias("d"), F.lit(1).alias("_one"))
    sz = fixture(spark, sf_dir, "part").agg(F.collect_set("p_size").alias("s"), F.lit(1).alias("_one"))
    days = ev.join(sz, "_one").select(F.array_sort(F.array_distinct(F.flatten(F.transform(
        "d", lambda x: F.transform("s", lambda y: F.date_add(x, y - 25))))))).scalar()
    users = fixture(spark, sf_dir, "events").select(F.col("user_id").alias("k")).distinct()
    f = fixture(spark, sf_dir, "fx_communes").join(users, "k", "left_semi")
    d = f.select("code_insee", "k", F.explode(days).alias("jour"))
    e = {
        "temperature_2m_max": "CAST((k*3+day(jour)*5)%64 AS DOUBLE)/4",
        "temperature_2m_min": "CAST((k*3+day(jour)*5)%64 AS DOUBLE)/4 - 8",
        "temperature_2m_mean": "CAST((k*3+day(jour)*5)%64 AS DOUBLE)/4 - 4",
        "precipitation_sum": "CASE WHEN (k+day(jour))%29=0 THEN NULL ELSE CAST((k*13+day(jour)*7)%40 AS DOUBLE)/16 END",
        "wind_speed_10m_max": "CAST((k*31+day(jour)*17)%160 AS DOUBLE)/8",
        "wind_speed_10m_mean": "CAST((k*31+day(jour)*17)%160 AS DOUBLE)/16",
        "relative_humidity_2m_max": "CAST(50+(k+day(jour))%50 AS DOUBLE)",
        "relative_humidity_2m_min": "CAST(20+(k+day(jour))%30 AS DOUBLE)",
        "relative_humidity_2m_mean": "CAST(35+(k+day(jour))%40 AS DOUBLE)",
        "sunshine_duration": "CAST(((k+day(jour))%12)*3600 AS DOUBLE)",
    }
    return d.select("code_insee", F.col("jour").alias("time"), *[F.expr(v).alias(k) for k, v in e.items()])


# Spark-side builders for the fixtures whose shared SQL text is a cross
# product of communes and days: the same rows, built by exploding a bounded
# day array next to each commune (no cross join in Spark plans).
SPARK_BUILDERS = {
    "fx_meteo": _spark_meteo,
    "fx_meteo_prev": _spark_meteo_prev,
    "fx_meteo_archive": _spark_meteo_archive,
    "fx_meteo_jour": _spark_meteo_jour,
}


_CACHE: dict[tuple, DataFrame] = {}


def _fixture_cached(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Fixture DataFrames are built once per (application, session, scale
    factor); a new or restarted session never sees another's plans."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir, name)
    if key not in _CACHE:
        _CACHE[key] = _build_fixture(spark, sf_dir, name)
    return _CACHE[key]


def _build_fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name in BASE_TABLES:
        return base_table(spark, sf_dir, name)
    if name in SPARK_BUILDERS:
        return SPARK_BUILDERS[name](spark, sf_dir)
    text = FX[name]
    args = {d: fixture(spark, sf_dir, d) for d in deps_of(text)}
    return spark.sql(text, **args)


def sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """Run Spark SQL text whose ``{names}`` are fixtures or base tables."""
    args = {d: fixture(spark, sf_dir, d) for d in deps_of(text)}
    return spark.sql(text, **args)


def _needed(text: str) -> list[str]:
    """Fixture views referenced (transitively) by oracle text, in order."""
    want: set[str] = set()

    def visit(t: str) -> None:
        for name in FX:
            if name not in want and re.search(rf"\b{name}\b", t):
                want.add(name)
                visit(FX[name])

    visit(text)
    return [n for n in FX if n in want]


def oracle(text: str) -> str:
    """DuckDB text: the needed fixture bodies as CTEs in front of ``text``.

    ``text`` may itself start with ``WITH``; its CTEs follow the fixtures.
    """
    body = text.strip()
    ctes = [f"{n} AS ({_resolve(FX[n]).strip()})" for n in _needed(body)]
    if not ctes:
        return body
    if body[:4].upper() == "WITH":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[4:].lstrip()
    return "WITH " + ",\n".join(ctes) + "\n" + body
