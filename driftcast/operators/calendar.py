"""Spraying calendar: rebasing, period counts, denominators and activity
(SURVEY C2–C4, D1–D3, E13, E21; rules R1–R3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftcast.functions.columns import month_period, rebase_year, treatment_flags, yes_no

# Treatment configurations: name, calendar-crop column, yearly IFT column,
# denominator column. FIXED VALUES of the method (rule R5).
CONFIGS = (
    ("maj", "c_maj_cal", "ift_maj_hbc", "nb_periodes_total"),
    ("hbc", "c_ift_hbc_cal", "ift_hh_hbc", "nb_periodes_fongi_insecti"),
    ("h", "c_ift_h_cal", "ift_h", "nb_periodes_herbicides"),
)


def config_filter(cfg: str):
    """R2: the treatment filter of a configuration (None = every period)."""
    if cfg == "maj":
        return F.lit(True)
    if cfg == "hbc":
        return F.col("fongicides") | F.col("insecticides")
    return F.col("herbicides")


def rebase_calendar(cal: DataFrame, annee: int, pad_departement: bool = False) -> DataFrame:
    """E1 part: departement as text (no zero padding unless asked, quirk Q2),
    periods moved to ``annee`` (B10)."""
    dep = F.col("departement_code").cast("string")
    if pad_departement:
        dep = F.lpad(dep, 2, "0")
    return cal.select(
        dep.alias("departement_code"), "culture",
        rebase_year("debut_de_periode", annee).alias("debut_de_periode"),
        rebase_year("fin_de_periode", annee).alias("fin_de_periode"),
        "herbicides", "fongicides", "insecticides")


def period_counts(cal: DataFrame) -> DataFrame:
    """R1 counts next to every calendar row, as window counts per
    (departement, culture). ``count_if`` over a window replaces the
    unsupported ``COUNT(*) FILTER`` window form."""
    w = Window.partitionBy("departement_code", "culture")
    return cal.select(
        "*",
        F.count_if(F.col("herbicides")).over(w).alias("nb_periodes_herbicides"),
        F.count_if(F.col("fongicides") | F.col("insecticides")).over(w).alias("nb_periodes_fongi_insecti"),
        F.count(F.lit(1)).over(w).alias("nb_periodes_total"))


def denominators(cal: DataFrame) -> DataFrame:
    """R1 as a table: one row per (departement, culture), whole calendar."""
    return cal.groupBy("departement_code", "culture").agg(
        F.count(F.lit(1)).alias("nb_periodes_total"),
        F.count_if(F.col("fongicides") | F.col("insecticides")).alias("nb_periodes_fongi_insecti"),
        F.count_if(F.col("herbicides")).alias("nb_periodes_herbicides"))


def dep_region_bridge(ift: DataFrame) -> DataFrame:
    """Distinct (departement, region) pairs of the IFT table."""
    return ift.select(F.col("code_insee_dep"), F.col("code_insee_reg")).distinct()


def regional_denominators(den: DataFrame, bridge: DataFrame) -> DataFrame:
    """Mean over the region's departements (present in both the
    calendar and the IFT table) of each denominator."""
    j = den.join(bridge, den.departement_code == bridge.code_insee_dep, "inner")
    # one value per (region, departement, culture) before the mean
    j = j.select("code_insee_reg", "departement_code", "culture", "nb_periodes_total",
                 "nb_periodes_fongi_insecti", "nb_periodes_herbicides").distinct()
    return j.groupBy("code_insee_reg", "culture").agg(
        F.avg("nb_periodes_total").alias("nb_periodes_total_reg"),
        F.avg("nb_periodes_fongi_insecti").alias("nb_periodes_fongi_insecti_reg"),
        F.avg("nb_periodes_herbicides").alias("nb_periodes_herbicides_reg"))


def active_days(cal: DataFrame) -> DataFrame:
    """Interval join "day between start and end" turned into an equi key.

    Each period of each configuration is exploded to its days
    (``sequence``), giving (cfg, departement, culture, date) — bounded by the
    calendar size times the period lengths, independent of the commune data.
    Overlapping periods give repeated rows; consumers de-duplicate once, at
    the end (``calendar_lookup``, ``distinct_active_days``).
    Periods with start > end (year-crossing after rebasing, quirk Q4) or a
    null bound are never active; they are dropped before ``sequence``, which
    would otherwise run backwards.
    """
    cfgs = F.array(*[F.when(config_filter(c), F.lit(c)) for c, *_ in CONFIGS])
    return (cal.where(F.col("debut_de_periode") <= F.col("fin_de_periode"))
               .select("departement_code", "culture", "debut_de_periode", "fin_de_periode",
                       F.explode(cfgs).alias("cfg"))
               .where(F.col("cfg").isNotNull())
               .select("cfg", "departement_code", "culture",
                       F.explode(F.sequence("debut_de_periode", "fin_de_periode")).alias("date")))


def distinct_active_days(cal: DataFrame) -> DataFrame:
    """C3 as a set: distinct active (cfg, departement, culture, day)."""
    return active_days(cal).distinct()


def region_active_days(act: DataFrame, bridge: DataFrame, dedupe: bool = True) -> DataFrame:
    """A (region, culture, day) is active when any departement of the
    region (through the bridge) is."""
    r = (act.join(bridge, act.departement_code == bridge.code_insee_dep, "inner")
            .where(F.col("code_insee_reg").isNotNull())
            .select("cfg", "code_insee_reg", "culture", "date"))
    return r.distinct() if dedupe else r


WORDS = 6  # 64-bit words that hold a year's days


def _period_word(cfg: str, word: int) -> str:
    """Bits of the days ``s`` to ``e`` (counted from January 1) of the periods
    of a configuration in one word, OR-ed. A null bound is never active:
    ``s <= e`` drops it, as greatest and least would skip it."""
    treats = {"maj": "true", "hbc": "(fongicides OR insecticides)", "h": "herbicides"}[cfg]
    lo, hi = f"greatest(s - {64 * word}, 0)", f"least(e - {64 * word}, 63)"
    bits = f"if({lo} <= {hi}, shiftrightunsigned(-1L, 63 - {hi}) & shiftleft(-1L, {lo}), 0L)"
    return f"bit_or(CASE WHEN {treats} AND s <= e THEN {bits} END) AS d_{cfg}_{word}"


def day_is_active(days: str, annee: int) -> Column:
    """Whether the bit of column ``date`` is set in a year's mask; a day
    outside the year, or no mask, is not active."""
    place = F.datediff("date", F.lit(dt.date(annee, 1, 1)))
    word = F.get(days, F.floor(place / 64).cast("int"))
    bit = F.call_function("shiftright", word, F.pmod(place, F.lit(64))).bitwiseAND(F.lit(1).cast("long"))
    return F.coalesce(bit == 1, F.lit(False))


def calendar_lookup(cal: DataFrame, bridge: DataFrame, annee: int, fallback: str = "quirk") -> DataFrame:
    """One row per (departement, region, culture) of the bridge pairs:
    ``nb_<cfg>`` = departement denominator, else regional mean (R3), and
    ``<cfg>_days`` = the year's days on which the departement or its region is
    active (R2/R3), as an array of 64-bit words. The departement flag is only
    ever true or null, so ``coalesce(dep, reg)`` of the reference equals this
    OR (quirk Q1 kept); with ``fallback="absent_only"`` the region stands in
    only for a departement without any period of that culture. ``reg_key``
    replaces a null region by '' so the key can be joined with plain equality.

    A period's days are set by arithmetic and periods OR-ed in the aggregate
    that also counts them: nothing is exploded, and the size follows
    departements × crops, not periods, communes or days. Periods with start >
    end (year-crossing after rebasing, quirk Q4) or a null bound are never
    active; R1 counts them."""
    names = [cfg for cfg, *_ in CONFIGS]
    words = [f"d_{cfg}_{w}" for cfg in names for w in range(WORDS)]
    jan1 = f"date'{annee:04d}-01-01'"
    # SQL text: one call per expression keeps building the plan cheap
    dep = cal.selectExpr("departement_code", "culture", "herbicides", "fongicides", "insecticides",
                         f"datediff(debut_de_periode, {jan1}) AS s", f"datediff(fin_de_periode, {jan1}) AS e")
    dep = dep.groupBy("departement_code", "culture").agg(*map(F.expr, [
        "count(1) AS nb_maj", "count_if(fongicides OR insecticides) AS nb_hbc", "count_if(herbicides) AS nb_h",
        *[_period_word(cfg, w) for cfg in names for w in range(WORDS)]]))
    of_dep = bridge.join(dep, bridge.code_insee_dep == dep.departement_code, "inner")
    of_reg = of_dep.where("code_insee_reg IS NOT NULL").groupBy("code_insee_reg", "culture").agg(*map(F.expr, [
        *[f"avg(nb_{cfg}) AS r_{cfg}" for cfg in names], *[f"bit_or({c}) AS r{c}" for c in words]]))
    own = of_dep.selectExpr("code_insee_dep", "code_insee_reg", "culture", "true AS own",
                            *[f"CAST(nb_{cfg} AS DOUBLE) AS n_{cfg}" for cfg in names], *words)
    of_region = bridge.join(of_reg, "code_insee_reg").selectExpr(
        "code_insee_dep", "code_insee_reg", "culture", "false AS own",
        *[f"r_{cfg}" for cfg in names], *[f"r{c}" for c in words])
    both = own.unionByName(of_region, allowMissingColumns=True).groupBy(
        "code_insee_dep", F.expr("coalesce(code_insee_reg, '') AS reg_key"), "culture").agg(*map(F.expr, [
            "max(own) AS own", *[f"max({c}_{cfg}) AS {c}_{cfg}" for cfg in names for c in ("n", "r")],
            *[f"bit_or({c}) AS {c}" for w in words for c in (w, f"r{w}")]]))

    def mask(cfg: str) -> str:
        region = "if(own, 0L, coalesce({}, 0L))" if fallback == "absent_only" else "coalesce({}, 0L)"
        parts = [f"coalesce(d_{cfg}_{w}, 0L) | {region.format(f'rd_{cfg}_{w}')}" for w in range(WORDS)]
        return f"array({', '.join(parts)}) AS {cfg}_days"

    return both.selectExpr("code_insee_dep", "reg_key", "culture",
                           *[f"coalesce(n_{cfg}, r_{cfg}) AS nb_{cfg}" for cfg in names], *map(mask, names))


def lookup_by_departement(lookup: DataFrame) -> DataFrame:
    """The lookup as one row per (departement, region): a map from culture
    (bounded by the crop names) to its denominators and masks."""
    values = F.struct(*[c for cfg, *_ in CONFIGS for c in (f"nb_{cfg}", f"{cfg}_days")])
    return lookup.where(F.col("culture").isNotNull()).groupBy("code_insee_dep", "reg_key").agg(
        F.map_from_entries(F.collect_list(F.struct("culture", values))).alias("crops"))


def build_calendar(sheet: DataFrame, annee: int, idf: DataFrame | None = None) -> DataFrame:
    """Main sheet ("Oui"/"Non" flags, dates moved to ``annee``) plus the
    Île-de-France month table when present (B8 flags from free text, B9
    month to first/last day), union with a null comment column (B21/H3)."""
    main = sheet.select(
        F.col("departement_code").cast("int").alias("departement_code"), "culture",
        rebase_year("debut_de_periode", annee).alias("debut_de_periode"),
        rebase_year("fin_de_periode", annee).alias("fin_de_periode"),
        yes_no("herbicides").alias("herbicides"),
        yes_no("fongicides").alias("fongicides"),
        yes_no("insecticides").alias("insecticides"),
        F.col("commentaires").cast("string").alias("commentaires"))
    if idf is None:
        return main
    start, end = month_period("periode", annee)
    extra = idf.select(
        F.col("departement_code").cast("int").alias("departement_code"), "culture",
        start.alias("debut_de_periode"), end.alias("fin_de_periode"),
        *treatment_flags("type"))
    return main.unionByName(extra, allowMissingColumns=True)
