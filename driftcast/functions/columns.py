"""Scalar Column expressions (family B).

All are built-in Spark functions so they stay inside whole-stage codegen;
no Python UDF anywhere.
"""

from __future__ import annotations

import calendar as _cal
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftcast.config import (CROP_MAP, DEFAULT_THRESHOLDS, MONTHS_FR, REGION_CODES,
                              V0_DISPERSION, V0_RAIN, V0_WIND_MAX, WEATHER_COLUMNS,
                              Thresholds)

__all__ = [
    "col_or", "map_literal", "map_crop", "pad_insee", "dep_of_insee", "parse_concentration",
    "detected", "yes_no", "treatment_flags", "month_number", "month_period", "rebase_year",
    "region_code", "region_name", "coerce_numeric", "lowercase_columns", "rename_existing",
    "normalise_weather_columns", "area_km2", "add_missing_columns", "safe_divide",
    "weather_indicator_cols", "level_0_4", "weather_flags_v0", "window_bounds",
    "hover_text", "days_in_year", "year_spine",
]


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(d: dict) -> Column:
    """A constant map column (folded by Catalyst into one literal), parsed
    from one SQL text: a call per entry would cost more than the plan."""
    def text(x):
        return str(x) if isinstance(x, int) else "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return F.expr(f"map({', '.join(map(text, chain.from_iterable(d.items())))})")


def map_crop(c: str | Column) -> Column:
    """IFT crop name -> calendar crop name; unknown or null -> null."""
    return F.try_element_at(map_literal(CROP_MAP), col_or(c))


def pad_insee(c: str | Column) -> Column:
    """Zero-pad to 5 characters; longer codes are kept whole (plain
    ``lpad`` would cut them)."""
    s = col_or(c).cast("string")
    return F.when(F.length(s) < 5, F.lpad(s, 5, "0")).otherwise(s)


def dep_of_insee(c: str | Column) -> Column:
    """Departement of a commune code = its first two characters."""
    return F.substring(pad_insee(c), 1, 2)


def parse_concentration(c: str | Column) -> Column:
    """B5: '<…' (below quantification) -> 0.0, else the number; bad text -> null."""
    s = col_or(c).cast("string")
    return F.when(s.contains("<"), F.lit(0.0)).otherwise(s.try_cast("double"))


def detected(c: str | Column) -> Column:
    """Not containing '<'. A null value counts as detected (quirk Q6)."""
    s = col_or(c).cast("string")
    return F.when(s.contains("<"), F.lit(False)).otherwise(F.lit(True))


def yes_no(c: str | Column) -> Column:
    """B7: 'oui' in any case -> true, other text -> false, null -> null."""
    return F.lower(col_or(c)) == F.lit("oui")


def treatment_flags(c: str | Column) -> list[Column]:
    """Herbicides / fongicides / insecticides named in free text (case-sensitive)."""
    s = col_or(c)
    return [s.contains("Herbicides").alias("herbicides"),
            s.contains("Fongicides").alias("fongicides"),
            s.contains("Insecticides").alias("insecticides")]


def month_number(c: str | Column) -> Column:
    """French month name in any case -> 1..12, unknown -> null."""
    return F.try_element_at(map_literal({m: i + 1 for i, m in enumerate(MONTHS_FR)}),
                            F.lower(col_or(c)))


def month_period(c: str | Column, annee: int) -> tuple[Column, Column]:
    """First and last day of the named month of ``annee``."""
    m = month_number(c)
    start = F.make_date(F.lit(annee), m, F.lit(1))
    return start, F.last_day(start)


def rebase_year(c: str | Column, annee: int) -> Column:
    """Keep month and day, set the year.

    February 29 into a common year would raise under ANSI; it becomes null
    instead (documented fix), counted by ``rebase_failures``.
    """
    d = col_or(c)
    made = F.make_date(F.lit(annee), F.month(d), F.dayofmonth(d))
    if _cal.isleap(annee):
        return made
    return F.when((F.month(d) == 2) & (F.dayofmonth(d) == 29), F.lit(None).cast("date")) \
            .otherwise(made)


def rebase_failures(df: DataFrame, cols: list[str], annee: int) -> DataFrame:
    """How many dates of each column cannot be moved to the year."""
    return df.agg(*[F.count_if(F.col(c).isNotNull() & rebase_year(c, annee).isNull()).alias(c) for c in cols])


def region_code(c: str | Column) -> Column:
    """Region name -> code, unknown -> null."""
    return F.try_element_at(map_literal(REGION_CODES), col_or(c))


def region_name(c: str | Column, default: str = "Autre") -> Column:
    """Region code -> name, else ``default`` ("Autre" / "Inconnue")."""
    inv = {v: k for k, v in REGION_CODES.items()}
    return F.coalesce(F.try_element_at(map_literal(inv), col_or(c)), F.lit(default))


def coerce_numeric(c: str | Column, to: str = "double") -> Column:
    """Text -> number, bad values -> null."""
    return col_or(c).try_cast(to)


def lowercase_columns(df: DataFrame) -> DataFrame:
    """B14."""
    return df.toDF(*[c.lower() for c in df.columns])


def rename_existing(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """B1: rename only the columns present."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def normalise_weather_columns(df: DataFrame) -> DataFrame:
    """B2: ``date`` -> ``time``; gusts stand in for mean wind only when mean
    wind is absent (else dropped); keep the standard columns present, in
    standard order."""
    cols = df.columns
    if "date" in cols:
        df = df.withColumnRenamed("date", "time")
    if "wind_gusts_10m_max" in cols:
        if "wind_speed_10m_mean" in cols:
            df = df.drop("wind_gusts_10m_max")
        else:
            df = df.withColumnRenamed("wind_gusts_10m_max", "wind_speed_10m_mean")
    return df.select(*[c for c in WEATHER_COLUMNS if c in df.columns])


def area_km2(ha: str | Column) -> Column:
    """Hectares -> km²."""
    return col_or(ha) * F.lit(0.01)


def add_missing_columns(df: DataFrame, like: DataFrame) -> DataFrame:
    """Null columns of the right type, then the other table's order."""
    have = set(df.columns)
    for f in like.schema.fields:
        if f.name not in have:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df.select(*like.columns, *[c for c in df.columns if c not in set(like.columns)])


def safe_divide(num: Column, den: Column) -> Column:
    """num / den with the IEEE result for a zero denominator (±inf, NaN for 0/0)
    instead of the ANSI error; null stays null (quirk Q3)."""
    return (F.when(den == 0,
                   F.when(num > 0, F.lit(float("inf")))
                    .when(num < 0, F.lit(float("-inf")))
                    .otherwise(F.lit(float("nan"))))
             .otherwise(num / den))


def nan_as_null(c: str | Column) -> Column:
    """The query surface's rule for missing numbers: NaN is null (±inf stays)."""
    v = col_or(c)
    return F.when(~F.isnan(v), v)


def weather_indicator_cols(wind: str | Column = "wind_speed_10m_mean",
                           rain: str | Column = "precipitation_sum",
                           th: Thresholds = DEFAULT_THRESHOLDS) -> list[Column]:
    """Indicator 0/1/2 and the four flags, three-valued like SQL."""
    w, r = col_or(wind), col_or(rain)
    wet = r > F.lit(th.rain_limit)
    return [
        F.when(wet | (w >= F.lit(th.wind_strong)), F.lit(0))
         .when(w <= F.lit(th.wind_calm), F.lit(2))
         .otherwise(F.lit(1)).cast("int").alias("indicateur_meteo"),
        (w >= F.lit(th.wind_forbidden)).alias("interdiction_pulv"),
        (w >= F.lit(th.wind_strong)).alias("traitement_deconseille"),
        wet.alias("pluie_limitante"),
        (w < F.lit(th.wind_strong)).alias("risque_dispersion"),
    ]


def level_0_4(c: str | Column, cuts: tuple | list | Column = DEFAULT_THRESHOLDS.level_cuts) -> Column:
    """Null -> null, 0 -> 0, <= q1 -> 1, <= q2 -> 2, <= q3 -> 3, else 4.

    NaN compares above every number in Spark, so NaN and +inf land on 4.
    ``cuts`` is three numbers or one array Column (quantiles).
    """
    x = col_or(c)
    if isinstance(cuts, Column):
        q1, q2, q3 = cuts[0], cuts[1], cuts[2]
    else:
        q1, q2, q3 = (F.lit(float(v)) for v in cuts)
    return (F.when(x.isNull(), F.lit(None).cast("int"))
             .when(x == 0, F.lit(0))
             .when(x <= q1, F.lit(1))
             .when(x <= q2, F.lit(2))
             .when(x <= q3, F.lit(3))
             .otherwise(F.lit(4)).cast("int"))


def weather_flags_v0(wind_max: str | Column = "wind_speed_10m_max",
                     rain: str | Column = "precipitation_sum",
                     max_wind: float = V0_WIND_MAX, rain_min: float = V0_RAIN,
                     disp: float = V0_DISPERSION) -> list[Column]:
    """Earlier notebook flags (note: rain uses >=)."""
    w, r = col_or(wind_max), col_or(rain)
    return [(w >= F.lit(max_wind)).alias("vent_fort"),
            (r >= F.lit(rain_min)).alias("pluie"),
            ((w >= F.lit(disp)) & (w < F.lit(max_wind))).alias("dispersion")]


def window_bounds(start: str | Column, end: str | Column, days: int = 15) -> tuple[Column, Column]:
    """Start - days, end + days."""
    return F.date_sub(col_or(start), days), F.date_add(col_or(end), days)


def hover_text(name: str | Column, code: str | Column, dep: str | Column,
               region: str | Column, level: str | Column, label: str | Column) -> Column:
    """The label text of a commune; the level line only when not null."""
    lv = col_or(level)
    return F.concat(
        F.lit("<b>"), col_or(name), F.lit("</b> ("), col_or(code), F.lit(")<br>"),
        F.lit("Dép. "), col_or(dep), F.lit(" — "), F.coalesce(col_or(region), F.lit("")), F.lit("<br>"),
        F.when(lv.isNotNull(), F.concat(F.lit("Indicateur : "), lv.cast("int").cast("string"), F.lit("<br>")))
         .otherwise(F.lit("")),
        col_or(label))


def three_decimals(x: Column) -> Column:
    """A finite double with three decimals, rounded as C and Python do: by
    its exact binary value, ties to even (the JVM rounds the shortest decimal
    instead, so 0.6375, which is stored a little below, would go up)."""
    a = F.abs(x)
    k = F.floor(a * 1000)
    # exact sign of 2000 a - (2 k + 1): a split in halves whose products are exact
    high = a * 134217729.0 - (a * 134217729.0 - a)
    over = (high * 2000 - (2 * k + 1)) + (a - high) * 2000
    n = k + F.when((over > 0) | ((over == 0) & (k % 2 == 1)), 1).otherwise(0)
    return F.concat(F.when((x < 0), F.lit("-")).otherwise(F.lit("")), F.floor(n / 1000).cast("string"), F.lit("."),
                    F.lpad((n % 1000).cast("string"), 3, "0"))


def hover_day(is_forecast: str | Column, date: str | Column, level: str | Column, ift: str | Column,
              no_spray: str | Column, rain: str | Column) -> Column:
    """B19, daily variant: the label of one day of a commune's series."""
    lv, x = col_or(level), nan_as_null(ift)
    number = (F.when(x == float("inf"), F.lit("inf")).when(x == float("-inf"), F.lit("-inf"))
               .otherwise(three_decimals(x)))
    return F.concat(
        F.when(F.coalesce(col_or(is_forecast), F.lit(False)), F.lit("⚡ Prévision — ")).otherwise(F.lit("")),
        F.date_format(col_or(date), "dd/MM/yyyy"), F.lit("<br>Indicateur : "),
        F.coalesce(lv.cast("int").cast("string"), F.lit("—")), F.lit("<br>"),
        F.when(x.isNotNull(), F.concat(F.lit("IFT journalier : "), number, F.lit("<br>"))).otherwise(F.lit("")),
        F.when(F.coalesce(col_or(no_spray), F.lit(False)), F.lit("🚫 Vent fort ")).otherwise(F.lit("")),
        F.when(F.coalesce(col_or(rain), F.lit(False)), F.lit("🌧 Pluie")).otherwise(F.lit("")))


def days_in_year(annee: int) -> int:
    """366 when ``annee % 4 == 0`` (quirk Q5: the 4-year rule only)."""
    return 366 if annee % 4 == 0 else 365


def year_spine(annee: int) -> Column:
    """Array of every day of the year (explode it next to a key)."""
    import datetime as _dt
    d0 = _dt.date(annee, 1, 1)
    d1 = d0 + _dt.timedelta(days=days_in_year(annee) - 1)
    return F.sequence(F.lit(d0), F.lit(d1))
