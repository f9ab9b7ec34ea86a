"""Query surface: the data part of the REST routes and dashboard callbacks
(SURVEY I1–I12, C20, D30, D32). Parameters are Column values or plain
Python values bound as literals — never text pasted into SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftcast.functions.columns import nan_as_null
from driftcast.operators.display import map_join

SERIES_COLS = ("date", "risque_0_4", "ift_journalier_total", "risque_brut", "indicateur_meteo",
               "interdiction_pulv", "pluie_limitante", "risque_dispersion")


def _name_match(q: str) -> Column:
    # regex match of the upper-cased text; a null name never matches
    return F.coalesce(F.col("nom_commune").rlike(q.upper()), F.lit(False))


def communes_list(ref: DataFrame, region: str | None = None, departement: str | None = None,
                  q: str | None = None, limit: int = 200, offset: int = 0) -> DataFrame:
    """Equality filters, name regex, one page in code order."""
    df = ref
    if region:
        df = df.where(F.col("code_insee_reg") == F.lit(region))
    if departement:
        df = df.where(F.col("code_insee_dep") == F.lit(departement))
    if q:
        df = df.where(_name_match(q))
    return df.orderBy("code_insee").offset(offset).limit(limit)


def communes_search(ref: DataFrame, q: str, limit: int = 20) -> DataFrame:
    """At least two characters, same match, first ``limit``."""
    if q is None or len(q) < 2:
        raise ValueError("q must have at least 2 characters")
    return ref.where(_name_match(q)).orderBy("code_insee").limit(limit)


def commune_detail(ref: DataFrame, code: Column | str) -> DataFrame:
    """One row of the commune reference."""
    return ref.where(F.col("code_insee") == (code if isinstance(code, Column) else F.lit(code)))


def risk_map(ref: DataFrame, risk: DataFrame, day: Column, region: str | None = None,
             departement: str | None = None) -> DataFrame:
    """Communes (filtered) left join the risk of ``day``; a day
    without rows gives every commune with nulls, and so does a NaN. The
    filters also cut the risk side, before it is shuffled."""
    c = ref
    if region:
        c = c.where(F.col("code_insee_reg") == F.lit(region))
    if departement:
        c = c.where(F.col("code_insee_dep") == F.lit(departement))
    r = risk.where(F.col("date") == day)
    if region or departement:
        r = r.join(c.select(F.col("code_insee").alias("insee_com")).distinct(), "insee_com", "left_semi")
    return map_join(c, r.withColumn("ift_journalier_total", nan_as_null("ift_journalier_total")))


def stored_risk(table: DataFrame, date_from: dt.date, date_to: dt.date,
                departements: list[str] | None = None) -> DataFrame:
    """Rows of the stored risk table (A12 layout) for a day range and, if
    given, some departements: the year and departement become partition
    filters, the days a predicate of the Parquet scan."""
    t = table.where(F.col("annee").between(date_from.year, date_to.year) & F.col("date").between(date_from, date_to))
    if departements is not None:
        t = t.where(F.col("dep").isin(list(departements)))
    return t.drop("annee", "dep")


def forecast_map(ref: DataFrame, forecast: DataFrame, day: Column, days: DataFrame, **kw) -> DataFrame:
    """As I4 on forecasts; a day outside the forecast's ``days`` (its
    file's days, column ``date``) is an error raised by the query itself at
    run time."""
    n = days.where(F.col("date") == day).select(F.count(F.lit(1))).scalar()
    out = risk_map(ref, forecast, day, **kw)
    return out.where(F.when(n == 0, F.raise_error(F.lit("no forecast for this day"))).otherwise(F.lit(True)))


def risk_series(ref: DataFrame, risk: DataFrame, annee: int | None = None,
                date_from: Column | None = None, date_to: Column | None = None) -> DataFrame:
    """Per commune, its days (optional year and bounds) as an array
    of day structs sorted by day, next to name and calendar flag. A commune
    without rows has an empty array; the year is the requested one, else the
    year of its first day, else the current year. NaN is null. Each group
    holds the days of one commune (bounded by the period)."""
    r = risk
    if annee is not None:
        r = r.where(F.year("date") == F.lit(annee))
    if date_from is not None:
        r = r.where(F.col("date") >= date_from)
    if date_to is not None:
        r = r.where(F.col("date") <= date_to)
    r = r.withColumns({c: nan_as_null(c) for c in ("ift_journalier_total", "risque_brut")})
    s = r.groupBy("insee_com").agg(
        F.array_sort(F.collect_list(F.struct(*SERIES_COLS))).alias("_jours"),
        F.year(F.min("date")).alias("_annee"))
    info = ref.select("code_insee", "nom_commune", "has_calendar_data")
    j = info.join(s, info.code_insee == s.insee_com, "left")
    empty = F.array().cast(s.schema["_jours"].dataType)
    year = F.lit(annee) if annee is not None else F.coalesce("_annee", F.year(F.current_date()))
    return j.select(*info.columns, F.coalesce("_jours", empty).alias("jours"), year.cast("int").alias("annee"))


def calendar_query(cal: DataFrame, culture: str | None = None,
                   departement_code: int | None = None) -> DataFrame:
    """I8: case-insensitive substring on the crop, departement equality
    (0 ignored, as a falsy parameter), sorted."""
    df = cal
    if culture:
        df = df.where(F.col("culture").ilike(f"%{culture}%"))
    if departement_code:
        df = df.where(F.col("departement_code") == F.lit(int(departement_code)))
    return (df.select("departement_code", "culture", F.col("debut_de_periode").alias("debut"),
                      F.col("fin_de_periode").alias("fin"), "herbicides", "fongicides", "insecticides")
              .orderBy("departement_code", "culture", "debut", "fin"))


def measurements_query(m: DataFrame, code: Column | str | None = None, substance: str | None = None,
                       date_from=None, date_to=None, detected_only: bool = False,
                       limit: int = 500) -> DataFrame:
    """Filters on the sampling start, ordered by start then
    substance (tie: end, value), first ``limit`` rows."""
    df = m
    if code is not None:
        df = df.where(F.col("code_insee") == (code if isinstance(code, Column) else F.lit(code)))
    if substance:
        df = df.where(F.col("substance").ilike(f"%{substance}%"))
    if date_from is not None:
        df = df.where(F.col("debut_prelevement") >= F.lit(date_from))
    if date_to is not None:
        df = df.where(F.col("debut_prelevement") <= F.lit(date_to))
    if detected_only:
        df = df.where(F.col("detecte") == F.lit(True))
    return (df.select("code_insee", "nom_commune", "substance", "debut_prelevement", "fin_prelevement",
                      "annee", "semaine", "concentration_ng_m3", "detecte")
              .orderBy("debut_prelevement", "substance", "fin_prelevement",
                       F.col("concentration_ng_m3").asc_nulls_first(), "detecte")
              .limit(limit))


def selection_options(ref: DataFrame, region: str | None = None,
                      departement: str | None = None) -> DataFrame:
    """Cascading options: level ('region', 'departement', 'commune')
    and sorted distinct values below the chosen region / departement."""
    regs = ref.select(F.lit("region").alias("niveau"), F.col("code_insee_reg").alias("valeur")).distinct()
    d = ref if not region else ref.where(F.col("code_insee_reg") == F.lit(region))
    deps = d.select(F.lit("departement").alias("niveau"), F.col("code_insee_dep").alias("valeur")).distinct()
    c = d if not departement else d.where(F.col("code_insee_dep") == F.lit(departement))
    coms = c.select(F.lit("commune").alias("niveau"), F.col("code_insee").alias("valeur")).distinct()
    return regs.unionByName(deps).unionByName(coms).orderBy("niveau", "valeur")


def risk_between(risk: DataFrame, forecast: DataFrame | None, date_from: Column,
                 date_to: Column) -> DataFrame:
    """History and forecasts of communes in a day range."""
    h = risk.where(F.col("date").between(date_from, date_to)).withColumn("is_forecast", F.lit(False))
    if forecast is None:
        return h
    f = forecast.where(F.col("date").between(date_from, date_to)).withColumn("is_forecast", F.lit(True))
    return h.unionByName(f)


def measurements_within(m: DataFrame, date_from: Column, date_to: Column) -> DataFrame:
    """Measurements whose whole sampling window lies in the range."""
    return m.where((F.col("debut_prelevement") >= date_from) & (F.col("fin_prelevement") <= date_to))


def commune_day(snapshot: DataFrame) -> DataFrame:
    """Level, daily IFT and flags of the communes on the snapshot day,
    with mapped crops and the 'outside calendar' mark."""
    return snapshot.select("code_insee", "nom_commune", "risque_0_4", "ift_journalier_total",
                           "interdiction_pulv", "pluie_limitante", "risque_dispersion",
                           "c_maj_cal", "c_ift_hbc_cal", "c_ift_h_cal",
                           (~F.col("has_calendar_data")).alias("hors_calendrier"), "state", "label")


def compare_communes(risk: DataFrame, communes: DataFrame, codes: DataFrame | None, date_from: Column,
                     date_to: Column) -> DataFrame:
    """C20: risk rows of some communes (``codes``: a table with
    ``code_insee``) between two days, with names."""
    r = risk.where(F.col("date").between(date_from, date_to))
    c = communes.select("code_insee", "nom_commune")
    if codes is not None:
        r = r.join(codes.select(F.col("code_insee").alias("insee_com")).distinct(), "insee_com", "left_semi")
    return r.join(c, r.insee_com == c.code_insee, "left").drop("code_insee")


def distinct_values(df: DataFrame, col: str | Column, name: str) -> DataFrame:
    """Sorted distinct values of one column."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.alias(name)).distinct().orderBy(name)


def health_summary(ref: DataFrame, risk: DataFrame) -> DataFrame:
    """Communes loaded and the sorted list of years available."""
    n = ref.select(F.count(F.lit(1))).scalar()
    return risk.agg(F.array_sort(F.collect_set(F.year("date"))).alias("annees")) \
               .select(n.alias("nb_communes"), "annees")
