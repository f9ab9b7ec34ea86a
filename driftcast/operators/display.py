"""Commune reference, display states, map snapshots and series
(SURVEY C9, C10, C15, E15–E17, D22–D24, D28, D33, B16, B19, I12).

The reference does these with pandas row lambdas; here they are joins and
``when`` chains. The fixed state table is a 7-row literal, broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftcast.config import DEFAULT_CENTRE, DISPLAY_STATES
from driftcast.functions.columns import hover_text, map_crop, region_name
from driftcast.functions.geo import lambert93_to_wgs84


def communes_admin(fx_communes: DataFrame) -> DataFrame:
    """Commune reference with WGS84 coordinates (B17 on the planar point)."""
    lon, lat = lambert93_to_wgs84("x_l93", "y_l93")
    return fx_communes.select("code_insee", "nom_commune", "code_insee_dep", "code_insee_reg",
                              lon.alias("longitude"), lat.alias("latitude"))


def calendar_crops(calendar: DataFrame) -> DataFrame:
    """One row per departement (as text, no padding) with its calendar crops
    (a set, bounded by the crop names)."""
    return calendar.groupBy(F.col("departement_code").cast("string").alias("_dep")).agg(
        F.collect_set("culture").alias("_crops"))


def has_calendar_data(df: DataFrame, calendar: DataFrame, dep_col: str = "code_insee_dep") -> DataFrame:
    """Whether any of the three (departement, mapped crop) pairs is in the
    calendar, as a column of ``df`` (one join on the departement)."""
    mine = F.filter(F.array("c_maj_cal", "c_ift_hbc_cal", "c_ift_h_cal"), lambda c: c.isNotNull())
    j = df.join(calendar_crops(calendar), F.col(dep_col) == F.col("_dep"), "left")
    return j.withColumn("has_calendar_data", F.coalesce(F.arrays_overlap(mine, "_crops"), F.lit(False))) \
            .drop("_dep", "_crops")


def communes_ref(communes: DataFrame, ift: DataFrame, calendar: DataFrame) -> DataFrame:
    """Communes left join IFT (raw and mapped crops, three IFTs) plus
    the calendar flag (C9), using the communes' official departement."""
    i = ift.select(
        "insee_com", F.col("code_insee_dep").alias("code_insee_dep_ift"),
        "c_maj", map_crop("c_maj").alias("c_maj_cal"),
        "c_ift_hbc", map_crop("c_ift_hbc").alias("c_ift_hbc_cal"),
        "c_ift_h", map_crop("c_ift_h").alias("c_ift_h_cal"),
        "ift_t", "ift_h", "ift_hh_hbc")
    return has_calendar_data(communes.join(i, communes.code_insee == i.insee_com, "left"), calendar)


def state_table(spark) -> DataFrame:
    """The fixed display states with their order index."""
    return spark.createDataFrame(
        [(i, k, lab, col) for i, (k, lab, col) in enumerate(DISPLAY_STATES)],
        "state_order int, state string, label string, color string")


def display_state(has_cal: Column, level: Column) -> Column:
    """Not in calendar -> no_calendar; null level -> no_data; else the level."""
    return (F.when(~F.coalesce(has_cal, F.lit(False)), F.lit("no_calendar"))
             .when(level.isNull(), F.lit("no_data"))
             .otherwise(level.cast("int").cast("string")))


def with_state(df: DataFrame) -> DataFrame:
    """E15 + B19: state, label, colour (broadcast of the 7 fixed states),
    hover text with the level line only when the level is known."""
    st = F.broadcast(state_table(df.sparkSession))
    d = df.withColumn("state", display_state(F.col("has_calendar_data"), F.col("risque_0_4")))
    d = d.join(st, "state", "left")
    return d.withColumn("hover", hover_text("nom_commune", "code_insee", "code_insee_dep",
                                            region_name("code_insee_reg"), "risque_0_4", "label"))


RISK_MAP_COLS = ("risque_0_4", "ift_journalier_total", "interdiction_pulv", "pluie_limitante",
                 "risque_dispersion")


def map_join(ref: DataFrame, risk_day: DataFrame) -> DataFrame:
    """Communes left join the risk rows of one day (communes without a
    row stay, with nulls)."""
    r = risk_day.select(F.col("insee_com").alias("_k"), *RISK_MAP_COLS)
    return ref.join(r, ref.code_insee == r._k, "left").drop("_k")


def pick_source(history: DataFrame, forecast: DataFrame | None, day: Column,
                prefer: str = "forecast", history_days: DataFrame | None = None,
                forecast_days: DataFrame | None = None) -> DataFrame:
    """E16 source choice, decided per day (not per commune): the preferred
    table when it has rows for the day, else the other one.

    Whether a table covers the day is read from its day list (the forecast
    file's days, the days of the stored year), a small table, through a
    scalar subquery — the risk tables themselves are scanned once, no
    driver-side branch.
    """
    def covers(days):
        if days is None:
            return F.lit(True)
        return days.where(F.col("date") == day).select(F.count(F.lit(1)) > 0).scalar()

    if forecast is None:
        return history.where(F.col("date") == day).withColumn("is_forecast", F.lit(False))
    h = history.where(F.col("date") == day).withColumn("is_forecast", F.lit(False))
    f = forecast.where(F.col("date") == day).withColumn("is_forecast", F.lit(True))
    if prefer == "forecast":
        use_f = covers(forecast_days)
        return f.where(use_f).unionByName(h.where(~use_f))
    use_h = covers(history_days)
    return h.where(use_h).unionByName(f.where(~use_h))


def map_snapshot(ref: DataFrame, history: DataFrame, forecast: DataFrame | None, day: Column,
                 prefer: str = "forecast", history_days: DataFrame | None = None,
                 forecast_days: DataFrame | None = None) -> DataFrame:
    """Communes with the day's risk (C15) and their display state (E15),
    from two risk tables. Where the risk is yet to be computed,
    ``risk.risk_of_day`` chooses the source first (``day_map``)."""
    src = pick_source(history, forecast, day, prefer, history_days, forecast_days)
    return with_state(map_join(ref, src))


def day_map(ref: DataFrame, risk_day: DataFrame) -> DataFrame:
    """Communes with the given risk rows of one day and their state."""
    return with_state(map_join(ref, risk_day))


def state_counts(snapshot: DataFrame) -> DataFrame:
    """Communes per display state over the fixed 7-state list (zero
    counts kept), and the 'moderate' group = levels 2 and 3."""
    st = F.broadcast(state_table(snapshot.sparkSession))
    c = snapshot.groupBy("state").agg(F.count(F.lit(1)).alias("nb_communes"))
    out = st.join(c, "state", "left").select(
        "state", "state_order", F.coalesce("nb_communes", F.lit(0)).cast("bigint").alias("nb_communes"))
    mod = out.where(F.col("state").isin("2", "3")).agg(
        F.lit("moderate").alias("state"), F.lit(None).cast("int").alias("state_order"),
        F.coalesce(F.sum("nb_communes"), F.lit(0)).cast("bigint").alias("nb_communes"))
    return out.unionByName(mod)


def days_over(risk: DataFrame, over: int = 3, at: int = 4) -> DataFrame:
    """Per commune, days with level >= ``over`` and days at ``at``
    (null level counted as 0)."""
    lv = F.coalesce(F.col("risque_0_4"), F.lit(0))
    return risk.groupBy("insee_com").agg(F.count_if(lv >= over).alias(f"jours_niveau_{over}_plus"),
                                         F.count_if(lv == at).alias(f"jours_niveau_{at}"))


def level_distribution(risk: DataFrame) -> DataFrame:
    """Days and share (%) per level, null as -1, per commune."""
    g = risk.groupBy("insee_com", F.coalesce(F.col("risque_0_4"), F.lit(-1)).alias("niveau")) \
            .agg(F.count(F.lit(1)).alias("nb_jours"))
    return g.withColumn("pct", F.col("nb_jours") * 100.0 / F.sum("nb_jours").over(Window.partitionBy("insee_com")))


def weather_flag_days(risk: DataFrame) -> DataFrame:
    """Days per weather flag, per commune."""
    return risk.groupBy("insee_com").agg(
        F.count_if("interdiction_pulv").alias("jours_interdiction"),
        F.count_if("traitement_deconseille").alias("jours_deconseille"),
        F.count_if("pluie_limitante").alias("jours_pluie"),
        F.count_if("risque_dispersion").alias("jours_dispersion"))


def annual_reconstruction(risk: DataFrame, ift: DataFrame) -> DataFrame:
    """Max daily IFT, days > 0, days without a value (null or NaN) and
    the sum of the daily IFT of each commune beside its yearly IFT. The sum
    adds quotients, so it is taken in ascending order over the commune's days
    (bounded: one year)."""
    from driftcast.functions.aggs import ordered_sum
    from driftcast.functions.columns import nan_as_null
    x = F.col("_x")
    g = risk.select("insee_com", nan_as_null("ift_journalier_total").alias("_x")).groupBy("insee_com").agg(
        F.max(x).alias("ift_j_max"), F.count_if(x > 0).alias("jours_positifs"),
        F.count_if(x.isNull()).alias("jours_nuls"), ordered_sum("_x").alias("somme_ift_j"))
    return g.join(ift.select("insee_com", F.col("ift_t_hbc").alias("ift_annuel")), "insee_com", "left")


def map_centre(selection: DataFrame) -> DataFrame:
    """Mean latitude / longitude of the selection, default when empty."""
    return selection.agg(F.coalesce(F.avg("latitude"), F.lit(DEFAULT_CENTRE[0])).alias("lat"),
                         F.coalesce(F.avg("longitude"), F.lit(DEFAULT_CENTRE[1])).alias("lon"))


def available_dates(spark, annee: int, today: Column, forecast: DataFrame | None) -> DataFrame:
    """Days of the year up to today, union the forecast days, sorted."""
    from driftcast.functions.columns import year_spine
    days = spark.range(1).select(F.explode(year_spine(annee)).alias("date")).where(F.col("date") <= today)
    if forecast is not None:
        days = days.unionByName(forecast.select(F.col("time").alias("date")))
    return days.distinct().orderBy("date")


def commune_series(history: DataFrame, forecast: DataFrame | None, keep: str = "both") -> DataFrame:
    """History and forecasts of communes by day, ``is_forecast`` flag.
    ``keep='both'`` keeps both rows on overlapping days (dashboard);
    ``keep='history'`` keeps the history row but marks the day as forecast
    when the forecast has it (notebook behaviour)."""
    h = history.withColumn("is_forecast", F.lit(False))
    if forecast is None:
        return h
    f = forecast.withColumn("is_forecast", F.lit(True))
    if keep == "both":
        return h.unionByName(f)
    fdays = forecast.select(F.col("insee_com").alias("_fc"), F.col("date").alias("_fd")).distinct()
    u = h.withColumn("_p", F.lit(0)).unionByName(f.withColumn("_p", F.lit(1)))
    w = Window.partitionBy("insee_com", "date").orderBy("_p")
    kept = u.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn", "_p")
    kept = kept.join(fdays, (F.col("insee_com") == F.col("_fc")) & (F.col("date") == F.col("_fd")), "left")
    return kept.withColumn("is_forecast", F.col("_fd").isNotNull()).drop("_fd", "_fc")
