"""Daily treatment pressure and risk per commune.

The reference walks the year one day at a time (365 × 3 configurations ×
4 joins). Here the year is one logical plan:

1. calendar lookup: one row per (departement, region, crop) with the R1/R3
   denominators and, per configuration, the year's active days as bits
   (departement or region fallback already folded in);
2. commune side (small, day-independent): IFT rows, mapped crops, the lookup
   joined once per departement, the fixed part of R4 and the R5
   de-duplication flags; hash-partitioned once on ``insee_com``;
3. weather: a commune's rows of the period become one array, joined to its
   one row of 2 (co-partitioned, before any day exists);
4. spine: every commune exploded to its days, each with its weather row
   (narrow, keeps the commune partitioning, so the big side is neither
   shuffled nor sorted); activity is one array access and a bit test per
   day; days without any weather row are neutral (E4) through a broadcast of
   at most 366 covered days;
5. R4/R5, gross risk and the 0–4 level in one projection.

Building the plan runs no Spark job; every join side is left to AQE except
the covered days, which the calendar bounds.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.config import DEFAULT_THRESHOLDS, REGION_CODES, Thresholds
from driftcast.functions.columns import (days_in_year, level_0_4, map_crop,
                                         weather_indicator_cols, year_spine)
from driftcast.operators.calendar import (CONFIGS, calendar_lookup, day_is_active, denominators, dep_region_bridge,
                                          lookup_by_departement, rebase_calendar)
from driftcast.operators.sizing import bounded_broadcast
from driftcast.session import shared_path

RISK_COLUMNS = (
    "insee_com", "date", "ift_journalier_total", "indicateur_meteo", "interdiction_pulv",
    "traitement_deconseille", "pluie_limitante", "risque_dispersion", "wind_speed_10m_mean",
    "precipitation_sum", "risque_brut", "risque_0_4",
)

@dataclass
class RiskInputs:
    ift: DataFrame            # one row per commune: crops, mapped crops, yearly IFTs
    cal: DataFrame            # calendar rebased to ``annee``
    weather: DataFrame | None  # code_insee, time, wind, rain (whole file, no region filter)
    annee: int
    # quirk switches: Q1 regional activity also for a departement present but
    # inactive ("quirk", the reference) or only for an absent one
    # ("absent_only"); Q3 zero denominator -> IEEE inf/NaN ("ieee") or null
    fallback: str = "quirk"
    zero_division: str = "ieee"
    regional: bool = False  # ``ift`` holds one region: weather is cut to its communes
    # the commune side as a plan, built once for all plans on these inputs
    memo: dict = field(default_factory=dict, repr=False, compare=False)


def check_region(region: str | None) -> str | None:
    """Region name -> code; an unknown name is an error naming the
    valid ones."""
    if region is None:
        return None
    if region not in REGION_CODES:
        raise ValueError(f"Unknown region: '{region}'. Valid regions: "
                         + ", ".join(sorted(REGION_CODES)))
    return REGION_CODES[region]


def load_inputs(ift_enrichi: DataFrame, calendar: DataFrame, weather: DataFrame | None,
                annee: int, region: str | None = None, pad_departement: bool = False,
                fallback: str = "quirk", zero_division: str = "ieee") -> RiskInputs:
    """IFT rows with a yearly total, optional region filter (pushed to
    the scan), mapped crops (B3), calendar rebased to the year (B10)."""
    code = check_region(region)
    ift = ift_enrichi.where(F.col("ift_t").isNotNull())
    if code is not None:
        ift = ift.where(F.col("code_insee_reg") == F.lit(code))
    ift = ift.select(
        "insee_com", "code_insee_dep", "code_insee_reg",
        "c_maj", F.col("ift_t_hbc").alias("ift_maj_hbc"),
        "c_ift_hbc", "ift_hh_hbc", "c_ift_h", "ift_h",
        map_crop("c_maj").alias("c_maj_cal"),
        map_crop("c_ift_hbc").alias("c_ift_hbc_cal"),
        map_crop("c_ift_h").alias("c_ift_h_cal"))
    cal = rebase_calendar(calendar, annee, pad_departement=pad_departement)
    if weather is not None:
        weather = weather.select("code_insee", "time", "wind_speed_10m_mean", "precipitation_sum")
    return RiskInputs(ift=ift, cal=cal, weather=weather, annee=annee, fallback=fallback,
                      zero_division=zero_division, regional=code is not None)


def commune_base(inp: RiskInputs) -> DataFrame:
    """Day-independent part of R3–R5 per commune.

    For each configuration: the denominator (departement, else regional
    mean), ``<cfg>_fixed`` = the R4 branches that do not depend on the day
    (no denominator or no IFT) with their value ``<cfg>_fixval``, the ratio
    used on active days, and ``<cfg>_days``, the mask of active days of the
    year (null: never active).
    """
    lookup = lookup_by_departement(calendar_lookup(inp.cal, dep_region_bridge(inp.ift), inp.annee, inp.fallback)).select(
        F.col("code_insee_dep").alias("_dep"), F.col("reg_key").alias("_reg"), "crops")
    df = inp.ift.withColumn("reg_key", F.coalesce(F.col("code_insee_reg"), F.lit("")))
    df = df.join(lookup, (F.col("code_insee_dep") == F.col("_dep")) & (F.col("reg_key") == F.col("_reg")), "left")
    # SQL text: these are some hundred calls as columns, more than planning costs
    df = df.selectExpr("*", *[f"try_element_at(crops, {cul}) AS _{cfg}" for cfg, cul, *_ in CONFIGS])
    return df.selectExpr(
        *[c for c in df.columns if c not in ("_dep", "_reg", "crops", *(f"_{cfg}" for cfg, *_ in CONFIGS))],
        *[text for cfg, _, ift, _ in CONFIGS for text in (
            f"_{cfg}.nb_{cfg} AS nb_{cfg}", f"_{cfg}.{cfg}_days AS {cfg}_days",
            f"_{cfg}.nb_{cfg} IS NULL OR {ift} IS NULL AS {cfg}_fixed",
            f"CASE WHEN {ift} IS NULL OR {ift} = 0 THEN 0D END AS {cfg}_fixval",
            (_ieee_ratio(ift, f"_{cfg}.nb_{cfg}") if inp.zero_division == "ieee"
             else f"try_divide({ift}, _{cfg}.nb_{cfg})") + f" AS {cfg}_ratio")],
        "coalesce(c_ift_hbc_cal != c_maj_cal, true) AS hbc_different",
        "coalesce(c_ift_h_cal != c_maj_cal, true) AS h_different")


def _ieee_ratio(num: str, den: str) -> str:
    """``safe_divide`` as SQL text."""
    return (f"CASE WHEN {den} = 0 THEN CASE WHEN {num} > 0 THEN double('Infinity') WHEN {num} < 0 THEN "
            f"double('-Infinity') ELSE double('NaN') END ELSE {num} / {den} END")


def daily_contributions(spine: DataFrame, annee: int) -> DataFrame:
    """Per commune-day, the three contributions (R4) and their total
    (R5); a day is looked up in the year's masks (outside it: not active)."""
    active = [day_is_active(f"{cfg}_days", annee).alias(f"_{cfg}_active") for cfg, *_ in CONFIGS]
    kept = [c for c in spine.columns if not c.endswith("_days")]
    df = spine.select(*kept, *active).selectExpr(*kept, *[
        f"CASE WHEN {c}_fixed THEN {c}_fixval WHEN _{c}_active THEN {c}_ratio ELSE 0D END AS ift_j_{c}"
        for c, *_ in CONFIGS])
    return df.selectExpr("*", """CASE WHEN ift_j_maj IS NOT NULL OR hbc_different AND ift_j_hbc IS NOT NULL
            OR h_different AND ift_j_h IS NOT NULL
        THEN coalesce(ift_j_maj, 0D) + CASE WHEN hbc_different THEN coalesce(ift_j_hbc, 0D) ELSE 0D END
            + CASE WHEN h_different THEN coalesce(ift_j_h, 0D) ELSE 0D END
        END AS ift_journalier_total""")


def spine_partitions(spark: SparkSession, partitions: int | None = None) -> int:
    """``driftcast.spinePartitions``, by default
    ``spark.sql.shuffle.partitions``."""
    return partitions or int(spark.conf.get("driftcast.spinePartitions",
                                            spark.conf.get("spark.sql.shuffle.partitions")))


def spine(base: DataFrame, days: Column, partitions: int | None = None) -> DataFrame:
    """Commune × day rows: the commune table is hash-partitioned on
    ``insee_com`` once and each row exploded to its days (narrow).

    The count is explicit, so AQE does not size partitions by the small
    commune rows (``spine_partitions``). A partition holds communes ×
    days / count rows; choose the count for a few million of them."""
    n = spine_partitions(base.sparkSession, partitions)
    return base.repartition(n, "insee_com").select("*", F.explode(days).alias("date"))


def weather_spine(base: DataFrame, days: Column, weather: DataFrame, d0, d1,
                  partitions: int | None = None, communes: DataFrame | None = None) -> DataFrame:
    """The rows of ``spine`` left-joined with the weather rows on
    (commune, day): ``_met`` is true with wind and rain, or all three null.
    A day with several weather rows has as many rows. ``days`` are distinct.

    The join is on the commune alone, before its row is exploded: commune ×
    day rows are many times the weather's, and joining them would sort them
    all. A commune's weather rows of the period (a year's days) are one array;
    the hash side is the commune rows, the arrays are streamed.
    """
    n = spine_partitions(base.sparkSession, partitions)
    w = weather if communes is None else weather.join(
        communes.select(F.col("insee_com").alias("code_insee")).distinct(), "code_insee", "left_semi")
    w = w.where(F.col("code_insee").isNotNull() & F.col("time").between(_as_col(d0), _as_col(d1)))
    fields = ("date", "wind_speed_10m_mean", "precipitation_sum", "_met")
    own = (w.repartition(n, "code_insee").groupBy(F.col("code_insee").alias("_w_com")).agg(
        F.collect_list(F.struct(F.col("time").alias("date"), *fields[1:3], F.lit(True).alias("_met"))).alias("_own")))
    row = own.schema["_own"].dataType.elementType
    rows = own.join(base.repartition(n, "insee_com").hint("shuffle_hash"), F.col("insee_com") == F.col("_w_com"), "right")
    rows = rows.select(*base.columns, days.alias("_spine"),
                       F.coalesce("_own", F.array().cast(T.ArrayType(row))).alias("_own"))
    # weather of other days than the spine's (the period may be wider)
    outside = F.size(F.array_except("_own.date", "_spine")) > 0
    met = F.when(outside, F.filter("_own", lambda x: F.array_contains("_spine", x["date"]))).otherwise(F.col("_own"))
    rows = rows.select(*base.columns, met.alias("_own"), F.array_except("_spine", "_own.date").alias("date"),
                       *[F.array().cast(T.ArrayType(row[f].dataType)).alias(f) for f in fields[1:]])
    return rows.select(*base.columns, F.inline(F.concat("_own", F.arrays_zip(*fields))))


def _as_col(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def attach_weather(df: DataFrame, weather: DataFrame | None, d0, d1, th: Thresholds,
                   neutral_days: bool = True) -> DataFrame:
    """E3–E5 on the commune-day table (of ``weather_spine``, or of ``spine``
    without weather).

    A day with no weather row for any commune (or no weather at all) is
    neutral for every commune (E4): indicator 1, flags false, dispersion
    true, values null. On a covered day a commune without a row gets nulls.
    The covered days always come from the whole table; their list is at most
    one row per day of the period and is broadcast.
    """
    neutral = {
        "indicateur_meteo": F.lit(1).cast("int"), "interdiction_pulv": F.lit(False),
        "traitement_deconseille": F.lit(False), "pluie_limitante": F.lit(False),
        "risque_dispersion": F.lit(True), "wind_speed_10m_mean": F.lit(None).cast("double"),
        "precipitation_sum": F.lit(None).cast("double"),
    }
    if weather is None:
        out = df.select("*", *[v.alias(k) for k, v in neutral.items()])
    else:
        kept = [c for c in df.columns if c not in ("_met", "wind_speed_10m_mean", "precipitation_sum")]
        joined = df.select(*kept, *[F.when(F.col("_met"), c).alias(k) for c, k in zip(
            [*weather_indicator_cols(th=th), F.col("wind_speed_10m_mean"), F.col("precipitation_sum")], neutral, strict=True)])
        if neutral_days:
            covered = bounded_broadcast(   # <= one row per day of [d0, d1]
                weather.where(F.col("time").between(_as_col(d0), _as_col(d1)))
                .select(F.col("time").alias("_c_date")).distinct()
                .select("_c_date", F.lit(True).alias("_covered")))
            joined = joined.join(covered, F.col("date") == F.col("_c_date"), "left")
            cov = F.col("_covered").isNotNull()
            out = joined.select(*kept, *[F.when(cov, F.col(k)).otherwise(v).alias(k) for k, v in neutral.items()])
        else:
            out = joined
    product = F.col("ift_journalier_total") * F.col("indicateur_meteo")
    # inf x 0 gives a NaN with the sign bit set; one NaN for all
    return out.select("*", F.when(F.isnan(product), F.lit(float("nan"))).otherwise(product).alias("risque_brut"))


def _days_with_weather(inp: RiskInputs, base: DataFrame, days: Column, d0, d1, weather: DataFrame | None,
                       partitions: int | None = None) -> DataFrame:
    """The spine; of a region run the weather rows are cut to its communes
    before their shuffle."""
    if weather is None:
        return spine(base, days, partitions)
    return weather_spine(base, days, weather, d0, d1, partitions, inp.ift if inp.regional else None)


def _finish(df: DataFrame, cuts) -> DataFrame:
    return df.select(*RISK_COLUMNS[:-1], level_0_4("risque_brut", cuts).alias("risque_0_4"))


def risk_days(inp: RiskInputs, days: Column, d0: dt.date | Column | None = None,
              d1: dt.date | Column | None = None, th: Thresholds = DEFAULT_THRESHOLDS,
              weather: DataFrame | None = None, neutral_days: bool = True,
              partitions: int | None = None) -> DataFrame:
    """Risk rows for every commune and each day of ``days`` (array Column).

    ``d0``/``d1`` bound the days (dates or scalar subqueries) and reach the
    weather scan; without them the range of the day list is used, which
    Spark applies after the scan."""
    if d0 is None:
        d0, d1 = F.array_min(days), F.array_max(days)
    if "base" not in inp.memo:
        inp.memo["base"] = commune_base(inp)
    weather = weather if weather is not None else inp.weather
    df = daily_contributions(_days_with_weather(inp, inp.memo["base"], days, d0, d1, weather, partitions), inp.annee)
    df = attach_weather(df, weather, d0, d1, th, neutral_days=neutral_days)
    return _finish(df, th.level_cuts)


def risk_pairs(inp: RiskInputs, pairs: DataFrame, weather: DataFrame, everywhere: Column,
               th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Risk rows of the given (code_insee, time) pairs only, and of every
    commune on the days of ``everywhere`` (an array of some of the pairs'
    days). A commune's own days are one array (at most a year's), so the plan
    is that of ``risk_days`` with a day list per commune."""
    own = pairs.groupBy(F.col("code_insee").alias("_pair_com")).agg(F.collect_set("time").alias("_pair_days"))
    base = commune_base(inp).join(own, F.col("insee_com") == F.col("_pair_com"), "left")
    days = F.array_distinct(F.concat(F.coalesce("_pair_days", F.array().cast("array<date>")), everywhere))
    d0, d1 = pairs.select(F.min("time")).scalar(), pairs.select(F.max("time")).scalar()
    df = _days_with_weather(inp, base, days, d0, d1, weather).drop("_pair_com", "_pair_days")
    df = attach_weather(daily_contributions(df, inp.annee), weather, d0, d1, th)
    return _finish(df, th.level_cuts)


def risk_year(inp: RiskInputs, th: Thresholds = DEFAULT_THRESHOLDS,
              partitions: int | None = None, method: str = "valeurs") -> DataFrame:
    """The whole year (365/366 days) for every commune — the flagship.

    ``method`` chooses the level cuts (Q9): "valeurs" = the fixed thresholds,
    "quartiles" = the quartiles of the year's positive values (E7).

    Sorting by (commune, day) is left to the writer (``sortWithinPartitions``)
    or to the final display; the table itself is unordered.
    """
    d0 = dt.date(inp.annee, 1, 1)
    d1 = d0 + dt.timedelta(days=days_in_year(inp.annee) - 1)
    if method not in ("valeurs", "quartiles"):
        raise ValueError(f"Unknown method: '{method}'. Valid methods: valeurs, quartiles")
    risk = risk_days(inp, year_spine(inp.annee), d0, d1, th, partitions=partitions)
    return levels_by_quartiles(risk) if method == "quartiles" else risk


def risk_forecast(inp: RiskInputs, forecast: DataFrame | None,
                  th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame | None:
    """The same rules on the distinct days of the forecast file; no
    neutral days (every day comes from the file). None without a file.

    The day list is a scalar subquery (bounded: the distinct days of one
    forecast file), exploded next to each commune — no cross join.
    """
    if forecast is None:
        return None
    fc = forecast.select("code_insee", "time", "wind_speed_10m_mean", "precipitation_sum")
    days = fc.select(F.array_sort(F.collect_set("time"))).scalar()
    d0, d1 = fc.select(F.min("time")).scalar(), fc.select(F.max("time")).scalar()
    return risk_days(inp, days, d0, d1, th, weather=fc, neutral_days=False)


def risk_of_day(inp: RiskInputs, forecast: DataFrame | None, day: Column, prefer: str = "forecast",
                th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """The risk rows of one day from the preferred source, with
    ``is_forecast``; equal to ``display.pick_source`` on E8 and E9.

    The source is chosen on the weather, before any risk is computed, so one
    day costs one risk plan and not two. "forecast": the file when it has the
    day, else the year. "history": the year when the day is in it, else the
    file (no rows when the file does not have the day either). A day taken
    from the file is covered by it, so the neutral rule (E4) only bears on
    days of the year."""
    if forecast is None:
        return risk_days(inp, F.array(day), day, day, th).select("*", F.lit(False).alias("is_forecast"))
    cols = ("code_insee", "time", "wind_speed_10m_mean", "precipitation_sum")
    in_file = forecast.where(F.col("time") == day).select(F.count(F.lit(1)) > 0).scalar()
    from_file = in_file if prefer == "forecast" else F.coalesce(F.year(day) != F.lit(inp.annee), F.lit(True))
    days = F.array(day) if prefer == "forecast" else F.when(~from_file | in_file, F.array(day))
    weather = forecast.select(*cols).where((F.col("time") == day) & from_file)
    if inp.weather is not None:
        weather = weather.unionByName(inp.weather.select(*cols).where((F.col("time") == day) & ~from_file))
    return risk_days(inp, days, day, day, th, weather=weather).select("*", from_file.alias("is_forecast"))


def quartile_cuts(risk: DataFrame, col: str = "risque_brut") -> Column:
    """Exact q25/q50/q75 (linear interpolation) of the strictly
    positive values, as a scalar subquery.

    Values are first counted per distinct value (map-side combined), so the
    final percentile only sees (value, frequency) pairs — bounded by the
    number of distinct values, not by rows. No positive value -> all-null
    cuts, so every non-null level is 0 or 4 never happens: see ``levels_by_quartiles``.
    """
    return quartiles(risk, col).select("q").scalar()


def quartiles(risk: DataFrame, col: str = "risque_brut") -> DataFrame:
    """One row: ``q`` = exact [q25, q50, q75] of the positive values, from
    (value, frequency) pairs (see ``quartile_cuts``)."""
    from driftcast.functions.aggs import exact_percentiles
    positive = risk.where((F.col(col) > 0) & ~F.isnan(col))  # NaN is missing, not positive
    return exact_percentiles(positive, col, (0.25, 0.5, 0.75)).withColumnRenamed("p", "q")


def levels_by_quartiles(risk: DataFrame, col: str = "risque_brut",
                        materialize: bool = True) -> DataFrame:
    """Level 0–4 against the quartiles of the positive values; null and
    NaN have no level. When no value is positive every level is 0 (the
    notebook's rule).

    The table is read twice (cuts, then levels), so it is first staged as
    Parquet in the shared folder: the year plan runs once, and the cuts read
    one column of it.
    """
    if materialize:
        path = shared_path(risk.sparkSession, "risk-levels")
        risk.write.parquet(path)
        risk = risk.sparkSession.read.schema(risk.schema).parquet(path)
    q = quartile_cuts(risk, col)
    lvl = F.when(q.isNull(), F.lit(0)).when(~F.isnan(col), level_0_4(col, q))
    return risk.withColumn("risque_0_4", lvl)


def weather_indicator(weather: DataFrame, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """E3 on a weather table (rows kept, five columns added)."""
    return weather.select("*", *weather_indicator_cols(th=th))


def neutral_days(weather: DataFrame | None, annee: int) -> DataFrame:
    """Every day of the year with ``neutre`` = no weather row for any
    commune that day (all days when there is no weather)."""
    spark = weather.sparkSession
    days = spark.range(1).select(F.explode(year_spine(annee)).alias("date"))
    cov = bounded_broadcast(weather.select(F.col("time").alias("date")).distinct()
                            .withColumn("_c", F.lit(True)))
    return days.join(cov, "date", "left").select("date", F.col("_c").isNull().alias("neutre"))


def ift_split(inp: RiskInputs) -> DataFrame:
    """Per commune and configuration: calendar crop, yearly IFT (null
    as 0), number of periods of that type in the departement (0 when none),
    IFT per period (0 when no period), and whether it is included (R5)."""
    den = denominators(inp.cal)
    hd = F.coalesce(F.col("c_ift_hbc_cal") != F.col("c_maj_cal"), F.lit(True))
    h2 = F.coalesce(F.col("c_ift_h_cal") != F.col("c_maj_cal"), F.lit(True))
    rows = F.array(*[F.struct(F.lit(cfg).alias("config"), F.col(cul).alias("culture"),
                              F.coalesce(F.col(ic), F.lit(0.0)).alias("ift_annuel"),
                              F.lit(nb).alias("nb_col"),
                              (F.lit(True) if cfg == "maj" else hd if cfg == "hbc" else h2).alias("inclus"))
                     for cfg, cul, ic, nb in CONFIGS])
    long = inp.ift.select("insee_com", "code_insee_dep", F.inline(rows))
    d = den.select(F.col("departement_code").alias("_dep"), F.col("culture").alias("_cul"),
                   F.map_from_arrays(F.array(*[F.lit(nb) for *_, nb in CONFIGS]),
                                     F.array(*[F.col(nb) for *_, nb in CONFIGS])).alias("_nbs"))
    j = long.join(d, (F.col("code_insee_dep") == F.col("_dep")) & (F.col("culture") == F.col("_cul")), "left")
    nb = F.when(F.col("culture").isNull(), F.lit(None).cast("bigint")) \
          .otherwise(F.coalesce(F.col("_nbs")[F.col("nb_col")], F.lit(0)).cast("bigint"))
    return j.select("insee_com", "config", "culture", "ift_annuel", nb.alias("nb_periodes"),
                    F.when(F.col("culture").isNull(), F.lit(None).cast("double"))
                     .when(nb > 0, F.col("ift_annuel") / nb).otherwise(F.lit(0.0)).alias("ift_par_periode"),
                    "inclus")


def _crops_of(ift: DataFrame, *cols: str) -> DataFrame:
    """A row per commune and distinct calendar crop ``_cul`` of its three."""
    return ift.select(*cols, F.explode(F.array_distinct(F.array("c_maj_cal", "c_ift_hbc_cal", "c_ift_h_cal")))
                      .alias("_cul")).where(F.col("_cul").isNotNull())


def period_detail(inp: RiskInputs, th: Thresholds = DEFAULT_THRESHOLDS) -> DataFrame:
    """Every calendar period of each commune's three crops (its
    departement) with its flags and the commune's daily IFT on the day after
    the period start.

    The communes take their masks before they meet the calendar, so the daily
    IFT is read off next to each period: no commune × day table is built,
    shuffled or broadcast, and what is shuffled follows communes and periods.
    A period without a start has one row per commune and crop, without IFT."""
    crops = _crops_of(inp.ift, F.col("insee_com").alias("_com"), "code_insee_dep")
    base = commune_base(inp).drop("code_insee_dep", "culture").withColumn("_known", F.lit(True))
    cal = inp.cal.select(F.col("departement_code").alias("_dep"), F.col("culture"),
                         "debut_de_periode", "fin_de_periode", "herbicides", "fongicides", "insecticides",
                         F.date_add("debut_de_periode", 1).alias("jour_test"))
    dated = F.col("jour_test").isNotNull()

    def periods(communes: DataFrame, rows: DataFrame) -> DataFrame:
        return spread_join(communes, rows, ["code_insee_dep", "_cul"], ["_dep", "culture"])

    with_ift = daily_contributions(
        periods(crops.join(base, F.col("_com") == F.col("insee_com"), "left"), cal.where(dated))
        .withColumn("date", F.col("jour_test")), inp.annee)
    without = periods(crops, cal.where(~dated))
    kept = [F.col("_com").alias("insee_com"), "code_insee_dep", "culture", "debut_de_periode", "fin_de_periode",
            "herbicides", "fongicides", "insecticides", "jour_test"]
    return with_ift.select(*kept, F.when(F.col("_known"), F.col("ift_journalier_total")).alias("ift_journalier_total")).unionByName(
        without.select(*kept, F.lit(None).cast("double").alias("ift_journalier_total")))


def spread_join(left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str]) -> DataFrame:
    """Inner equi join of two small tables with a large result: both sides in
    as many partitions as a shuffle has, which AQE would merge by their own
    small size."""
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    on = [F.col(a) == F.col(b) for a, b in zip(left_keys, right_keys, strict=True)]
    return left.repartition(n, *left_keys).join(right.repartition(n, *right_keys).hint("merge"), on)


def calendar_of_communes(inp: RiskInputs) -> DataFrame:
    """E21 (every commune): rebased calendar rows of the commune's
    departement restricted to its three calendar crops, with the R1 counts."""
    from driftcast.operators.calendar import period_counts
    cal = period_counts(inp.cal)
    crops = _crops_of(inp.ift, "insee_com", "code_insee_dep")
    return spread_join(crops, cal, ["code_insee_dep", "_cul"], ["departement_code", "culture"]).drop("_cul", "code_insee_dep")
