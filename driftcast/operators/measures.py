"""Air measurements: cleaning, targeted-weather enrichment and descriptive
aggregates (SURVEY E11, E12, D4, C8, D18–D21, D37, D39, D40, L5).

The weather of each sampling window (start − 15 d, end + 15 d) is an
interval join: distinct windows are exploded to their days and equi-joined
with one daily weather table on (commune, day), then aggregated per window
and joined back to the measurements. Windows are few per station (one per
sampling period), the daily table grows with communes × days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftcast.config import MEASURE_RENAME, WINDOW_DAYS
from driftcast.functions.columns import (dep_of_insee, detected, pad_insee, parse_concentration,
                                         rename_existing, window_bounds)
from driftcast.functions.geo import lambert93_to_wgs84


def measurements_clean(sheet: DataFrame) -> DataFrame:
    """B1 rename, B4 pad + departement, B6 dates, B5 value and
    detection flag, B17 coordinates."""
    df = rename_existing(sheet, MEASURE_RENAME)
    lon, lat = lambert93_to_wgs84(F.col("x_lamb93").cast("double"), F.col("y_lamb93").cast("double"))
    conc = F.col("concentration_ng_m3")
    return df.withColumns({
        "code_insee": pad_insee("code_insee"),
        "code_insee_dep": dep_of_insee("code_insee"),
        "debut_prelevement": F.to_date("debut_prelevement"),
        "fin_prelevement": F.to_date("fin_prelevement"),
        "concentration_ng_m3": parse_concentration(conc),
        "detecte": detected(conc),
        "longitude": lon,
        "latitude": lat,
    })


def sampling_windows(clean: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """B18 + A11 dedup: distinct (commune, start − days, end + days) of the
    measurements with coordinates."""
    return sampling_points(clean, days).select("code_insee", "start_date", "end_date").distinct()


def sampling_points(clean: DataFrame, days: int = WINDOW_DAYS) -> DataFrame:
    """Distinct (commune, latitude, longitude, window): one weather
    request entry per location, also where a commune has several."""
    s, e = window_bounds("debut_prelevement", "fin_prelevement", days)
    return (clean.where(F.col("latitude").isNotNull())
                 .select("code_insee", "latitude", "longitude", s.alias("start_date"), e.alias("end_date")).distinct())


def weather_window_aggregates(windows: DataFrame, daily: DataFrame) -> DataFrame:
    """Per (commune, start, end) window, aggregates of the daily weather.

    Sums of an all-null window are 0 (the reference's sum); sunshine is
    aggregated when the column exists, else null (Q10 fix).

    Always a merge join: the planner takes exploded windows for as small as
    the windows, and would broadcast them.
    """
    days = windows.select("code_insee", "start_date", "end_date",
                          F.explode(F.sequence("start_date", "end_date")).alias("time"))
    j = days.join(daily.hint("merge"), ["code_insee", "time"], "inner")
    wmax, rain = F.col("wind_speed_10m_max"), F.col("precipitation_sum")
    sun = ([(F.coalesce(F.sum("sunshine_duration"), F.lit(0.0)) / 3600).alias("ensoleillement_h_total"),
            (F.avg("sunshine_duration") / 3600).alias("ensoleillement_h_moy")]
           if "sunshine_duration" in daily.columns else
           [F.lit(None).cast("double").alias("ensoleillement_h_total"),
            F.lit(None).cast("double").alias("ensoleillement_h_moy")])
    return j.groupBy("code_insee", "start_date", "end_date").agg(
        F.avg("temperature_2m_max").alias("temp_max_moy"),
        F.avg("temperature_2m_min").alias("temp_min_moy"),
        F.avg("temperature_2m_mean").alias("temp_moy"),
        F.avg(wmax).alias("vent_max_moy"),
        F.avg("wind_speed_10m_mean").alias("vent_moy"),
        F.max(wmax).alias("vent_max_abs"),
        F.coalesce(F.sum(rain), F.lit(0.0)).alias("precip_totale"),
        F.avg(rain).alias("precip_moy_jour"),
        F.avg("relative_humidity_2m_mean").alias("humidite_moy"),
        F.avg("relative_humidity_2m_max").alias("humidite_max_moy"),
        *sun,
        F.count_if((wmax >= 4) & (wmax < 11)).alias("nb_jours_dispersion"),
        F.count_if(wmax >= 11).alias("nb_jours_interdiction"),
        F.count_if(rain > 0).alias("nb_jours_pluie"))


def measurements_enriched(clean: DataFrame, daily: DataFrame | None,
                          days: int = WINDOW_DAYS) -> DataFrame:
    """Cleaned measurements left-joined with the aggregates of
    their window; without weather the cleaned table is returned."""
    if daily is None:
        return clean
    agg = weather_window_aggregates(sampling_windows(clean, days), daily)
    s, e = window_bounds("debut_prelevement", "fin_prelevement", days)
    m = clean.withColumns({"start_date": s, "end_date": e})
    return m.join(agg, ["code_insee", "start_date", "end_date"], "left")


def measure_totals(clean: DataFrame, keys: list[str]) -> DataFrame:
    """Per station (or coordinates) and sampling period: total
    concentration, distinct substances with a positive value."""
    c = F.col("concentration_ng_m3")
    return clean.groupBy(*keys).agg(
        F.coalesce(F.sum(c), F.lit(0.0)).alias("concentration_totale"),
        F.count_distinct(F.when(c > 0, F.col("substance"))).alias("nb_substances_detectees"))


def top_substances(clean: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` substances with the largest total detected
    concentration; their sums per (start day, substance) (top-k by
    ``orderBy.limit``, then a semi join)."""
    det = clean.where(F.col("concentration_ng_m3") > 0)
    top = (det.groupBy("substance").agg(F.sum("concentration_ng_m3").alias("total"))
              .orderBy(F.col("total").desc(), "substance").limit(n))
    return (det.join(F.broadcast(top.select("substance")), "substance", "left_semi")
               .groupBy("debut_prelevement", "substance")
               .agg(F.sum("concentration_ng_m3").alias("concentration_ng_m3")))


def total_per_day(clean: DataFrame) -> DataFrame:
    """Total detected concentration per start day."""
    return (clean.where(F.col("concentration_ng_m3") > 0).groupBy("debut_prelevement")
                 .agg(F.sum("concentration_ng_m3").alias("concentration_ng_m3")))


def substance_detail(clean: DataFrame) -> DataFrame:
    """Per substance: detections, sampled periods, max detected
    concentration (0 when none), median limit of quantification."""
    from driftcast.functions.aggs import exact_percentiles
    c = F.col("concentration_ng_m3")
    main = clean.groupBy("substance").agg(
        F.count_if(c > 0).alias("nb_detections"),
        F.count(F.lit(1)).alias("nb_periodes"),
        F.coalesce(F.max(F.when(c > 0, c)), F.lit(0.0)).alias("max_detecte"))
    # median from (value, frequency) pairs: a hot substance is pre-aggregated
    med = exact_percentiles(clean.select("substance", F.col("`LQ (ng/m3)`").alias("_lq")), "_lq", (0.5,),
                            ["substance"]).select("substance", F.col("p")[0].alias("lq_mediane"))
    return main.join(med, "substance", "left")


def substance_ranking(clean: DataFrame, n: int = 15) -> DataFrame:
    """Top ``n`` detected substances by total: sum, count, max."""
    det = clean.where(F.col("concentration_ng_m3") > 0)
    return (det.groupBy("substance").agg(
        F.sum("concentration_ng_m3").alias("total"),
        F.count("concentration_ng_m3").alias("n_periodes"),
        F.max("concentration_ng_m3").alias("max"))
        .orderBy(F.col("total").desc(), "substance").limit(n))


def detection_summary(clean: DataFrame) -> DataFrame:
    """Periods, substances analysed, substances detected, detection rate."""
    c = F.col("concentration_ng_m3")
    return clean.agg(
        F.count_distinct("debut_prelevement").alias("nb_periodes"),
        F.count_distinct("substance").alias("nb_substances"),
        F.count_distinct(F.when(c > 0, F.col("substance"))).alias("nb_substances_detectees"),
        (F.count_if(c > 0) * 100.0 / F.count(F.lit(1))).alias("taux_detection"))


def enrichment_rate(enriched: DataFrame) -> DataFrame:
    """Measurements with weather / all; distinct communes; year range;
    communes without coordinates (Q11 warning material)."""
    return enriched.agg(
        F.count_if(F.col("vent_moy").isNotNull()).alias("nb_enrichies"),
        F.count(F.lit(1)).alias("nb_mesures"),
        F.count_distinct("code_insee").alias("nb_communes"),
        F.min("annee").alias("annee_min"), F.max("annee").alias("annee_max"),
        F.count_distinct(F.when(F.col("latitude").isNull(), F.col("code_insee"))).alias("communes_sans_coords"))


def sampling_range(clean: DataFrame, daily: DataFrame) -> DataFrame:
    """First and last sampling day per station; daily weather of the
    station restricted to that range (join + between)."""
    rng = clean.groupBy("code_insee").agg(F.min("debut_prelevement").alias("premier"),
                                          F.max("fin_prelevement").alias("dernier"))
    return (daily.join(rng, "code_insee", "inner")
                 .where(F.col("time").between(F.col("premier"), F.col("dernier"))))


def stations_without_code(clean: DataFrame) -> DataFrame:
    """Distinct stations (name, network, coordinates) whose commune
    code is null."""
    return (clean.where(F.col("code_insee").isNull())
                 .select("nom_commune", "reseau", "x_lamb93", "y_lamb93").distinct())


def barycentre(clean: DataFrame, keys: list[str]) -> DataFrame:
    """Mean longitude and latitude of the points."""
    return clean.groupBy(*keys).agg(F.avg("longitude").alias("lon"), F.avg("latitude").alias("lat"))
