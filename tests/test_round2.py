"""Plan shape, storage safety, outlines and percentiles."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.fixtures import fixture
from driftcast.functions.aggs import exact_percentiles
from driftcast.functions.columns import hover_day
from driftcast.functions.geo import rings_area_centroid, rings_within
from driftcast.operators.calendar import (
    CONFIGS, calendar_lookup, denominators, distinct_active_days, rebase_calendar, region_active_days)
from driftcast.operators.geo import nearest_point, parcels_of_commune
from driftcast.operators.risk import load_inputs, risk_days, risk_year
from driftcast.plans.risk_q import ANNEE, inputs
from driftcast.session import shared_path
from driftcast.sources import tables as TB
from driftcast.sources import versions
from driftcast.streaming.incremental import upsert_weather
from tests.conftest import SF_SMALL
from tests.helpers import rows_of


def rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_building_the_year_runs_no_job(spark):
    inp = inputs(spark, SF_SMALL)  # opening the tables reads their schemas
    spark.sparkContext.setJobGroup("build", "build")
    try:
        df = risk_year(inp)
        risk_days(inp, F.array(F.lit(dt.date(2024, 1, 3))))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")
    assert df.columns


def joins_above_generate(text):
    """Join operators on the path from the root to the day explode."""
    lines = text.split("\n")
    at = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    depth, found = lines[at].index("Generate"), []
    for line in reversed(lines[:at]):
        name = line.lstrip(" :+-*(0123456789)")
        where = len(line) - len(name)
        if where < depth:
            depth = where
            if "Join" in name.split(" ")[0]:
                found.append(name.split(" ")[0])
    return found


def test_only_weather_and_covered_days_join_the_spine(spark):
    cal = fixture(spark, SF_SMALL, "fx_calendrier")
    plans = []
    for copies in (1, 100):
        many = cal.select("*", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_c")).drop("_c")
        inp = load_inputs(fixture(spark, SF_SMALL, "fx_ift"), many, fixture(spark, SF_SMALL, "fx_meteo"), ANNEE)
        plans.append(joins_above_generate(plan(risk_year(inp))))
    assert plans[0] == plans[1] and len(plans[0]) == 2


def test_region_cuts_weather_before_its_shuffle(spark):
    text = plan(risk_year(inputs(spark, SF_SMALL, region="Île-de-France")))
    assert "LeftSemi" in text


def test_calendar_lookup_masks_and_fallback(spark):
    d = dt.date
    cal = rebase_calendar(spark.createDataFrame(
        [("1", "Vigne", d(2023, 3, 1), d(2023, 3, 3), True, False, False),
         ("1", "Vigne", d(2023, 3, 3), d(2023, 3, 4), False, True, False),
         ("1", "Vigne", d(2023, 12, 20), d(2023, 1, 5), True, False, False),  # crosses the year: never active
         ("2", "Vigne", d(2023, 5, 1), d(2023, 5, 1), True, False, False)],
        "departement_code string, culture string, debut_de_periode date, fin_de_periode date, herbicides boolean, "
        "fongicides boolean, insecticides boolean"), 2024)
    bridge = spark.createDataFrame([("1", "11"), ("2", "11"), ("3", "11"), ("1", None)], "code_insee_dep string, code_insee_reg string")

    def days(fallback):
        out = {}
        for r in calendar_lookup(cal, bridge, 2024, fallback).collect():
            out[r["code_insee_dep"], r["reg_key"]] = (r["nb_maj"], r["nb_h"], {
                (d(2024, 1, 1) + dt.timedelta(i)).strftime("%m%d") for i in range(366) if r["h_days"][i // 64] >> (i % 64) & 1})
        return out

    quirk, strict = days("quirk"), days("absent_only")
    assert quirk["1", ""] == (3.0, 2.0, {"0301", "0302", "0303"})
    assert quirk["1", "11"][2] == {"0301", "0302", "0303", "0501"} and strict["1", "11"][2] == {"0301", "0302", "0303"}
    assert quirk["3", "11"] == strict["3", "11"] == (2.0, 1.5, {"0301", "0302", "0303", "0501"})


def test_calendar_lookup_null_bounds_are_never_active(spark):
    d = dt.date
    cal = rebase_calendar(spark.createDataFrame(
        [("1", "Vigne", None, d(2024, 3, 3), True, True, False), ("2", "Vigne", d(2024, 6, 1), None, True, False, True),
         ("3", "Vigne", None, None, True, True, True), ("4", "Vigne", d(2024, 2, 29), d(2024, 4, 9), True, True, False),
         ("5", "Vigne", d(2024, 1, 30), d(2024, 2, 29), False, True, False),
         ("6", "Vigne", None, d(2024, 5, 5), True, False, None), ("6", "Vigne", d(2024, 5, 4), d(2024, 7, 9), True, False, True),
         ("7", "Ble", d(2024, 1, 1), d(2024, 12, 31), None, True, None)],
        "departement_code string, culture string, debut_de_periode date, fin_de_periode date, herbicides boolean, "
        "fongicides boolean, insecticides boolean"), 2023)
    bridge = spark.createDataFrame([(str(i), "11" if i < 4 else "24") for i in range(1, 9)],
                                   "code_insee_dep string, code_insee_reg string")
    active = distinct_active_days(cal)
    own = {(r["departement_code"], r["culture"], r["cfg"], r["date"]) for r in active.collect()}
    region = {(r["code_insee_reg"], r["culture"], r["cfg"], r["date"]) for r in region_active_days(active, bridge).collect()}
    counts = {(r["departement_code"], r["culture"]): r["nb_periodes_total"] for r in denominators(cal).collect()}
    found = calendar_lookup(cal, bridge, 2023).collect()
    assert own and len(found) == 3 + 2 * 5
    for r in found:
        dep, culture = r["code_insee_dep"], r["culture"]
        assert (dep, culture) not in counts or r["nb_maj"] == counts[dep, culture]
        for cfg, *_ in CONFIGS:
            days = {d(2023, 1, 1) + dt.timedelta(i) for i in range(64 * 6) if r[f"{cfg}_days"][i // 64] >> (i % 64) & 1}
            want = {day for k, c, f, day in own if (k, c, f) == (dep, culture, cfg)} | {
                day for k, c, f, day in region if (k, c, f) == (r["reg_key"], culture, cfg)}
            assert days == want, (dep, culture, cfg)


def test_method_parameter(spark):
    inp = inputs(spark, SF_SMALL)
    with pytest.raises(ValueError, match="Valid methods"):
        risk_year(inp, method="autre")
    a = {(r[0], r[1]): r[2] for r in risk_year(inp, method="quartiles").select("insee_com", "date", "risque_0_4").collect()}
    values = {(r[0], r[1]): r[2] for r in risk_year(inp).select("insee_com", "date", "risque_brut").collect()}
    positive = np.array([v for v in values.values() if v is not None and v > 0])
    q = np.percentile(positive, [25, 50, 75])
    for k, v in values.items():
        want = None if v is None or v != v else 0 if v == 0 else 1 + int((v > q).sum())
        assert a[k] == want


# ---- storage ---------------------------------------------------------------

def year_rows(spark, risk, extra=False):
    df = spark.createDataFrame([(c, dt.date(2024, 1, 1), x) for c, x in risk], "insee_com string, date date, risque_brut double")
    return df.withColumn("nouvelle", F.lit(7)) if extra else df


def test_upsert_year_keeps_rows_and_columns(spark):
    p = shared_path(spark, "t")
    TB.upsert_year(spark, p, year_rows(spark, [("01001", 1.0), ("01002", 2.0), ("02001", 3.0)]), 2024)
    TB.upsert_year(spark, p, year_rows(spark, [("01002", 5.0)], extra=True), 2024)
    got = {r["insee_com"]: r["risque_brut"] for r in TB.read_risk(spark, p).collect()}
    assert got == {"01001": 1.0, "01002": 5.0, "02001": 3.0}
    stored = TB.read_risk(spark, p).where("dep = '01'")
    assert {(r["insee_com"], r["nouvelle"]) for r in stored.collect()} == {("01001", None), ("01002", 7)}
    before = rows(TB.read_risk(spark, p))
    TB.upsert_year(spark, p, year_rows(spark, [("01002", 5.0)], extra=True), 2024)
    assert rows(TB.read_risk(spark, p)) == before


def test_upsert_year_raises_and_leaves_the_table(spark):
    p = shared_path(spark, "t")
    TB.upsert_year(spark, p, year_rows(spark, [("01001", 1.0)]), 2024)
    with pytest.raises(Exception, match="nope"):
        TB.upsert_year(spark, p, year_rows(spark, [("01001", 9.0)]), 2024, key="nope")
    assert [r["risque_brut"] for r in TB.read_risk(spark, p).collect()] == [1.0]
    broken = shared_path(spark, "broken")
    os.makedirs(broken.removeprefix("file:"))
    with open(f"{broken.removeprefix('file:')}/part-0.parquet", "w") as f:
        f.write("no parquet")
    with pytest.raises(ValueError, match="not a versioned table"):
        TB.upsert_year(spark, broken, year_rows(spark, [("01001", 9.0)]), 2024)


def test_upsert_weather_keeps_rows_of_other_variables(spark):
    p = shared_path(spark, "w")
    key = "code_insee string, time date, fetched_at long"
    d = dt.date(2024, 1, 1)
    upsert_weather(spark, p, spark.createDataFrame([("a", d, 1, 3.0), ("b", d, 1, 4.0)], f"{key}, precipitation_sum double"))
    upsert_weather(spark, p, spark.createDataFrame([("b", d, 2, 5.0, 1.0)],
                                                   f"{key}, precipitation_sum double, wind_speed_10m_mean double"))
    got = {r["code_insee"]: (r["precipitation_sum"], r["wind_speed_10m_mean"])
           for r in versions.read(spark, p).collect()}
    assert got == {"a": (3.0, None), "b": (5.0, 1.0)}


def test_half_written_cache_is_computed_again(spark):
    p = shared_path(spark, "cache")
    TB.cached(spark, p, lambda: spark.range(3))
    assert TB.cached(spark, p, lambda: spark.range(9)).count() == 3
    os.remove(f"{p.removeprefix('file:')}/_SUCCESS")
    assert TB.cached(spark, p, lambda: spark.range(9)).count() == 9


def test_weather_switch_of_views(spark):
    p = shared_path(spark, "v")
    spark.range(1).write.parquet(p)
    names = [r["view"] for r in TB.register_views(spark, {"communes": p, "meteo_historique": p}, weather_enabled=False).collect()]
    assert names == ["communes"]


def test_stored_surface_prunes_partitions_and_pushes_days(spark):
    from driftcast.plans.surface import stored_risk
    p = shared_path(spark, "t")
    TB.upsert_year(spark, p, year_rows(spark, [("01001", 1.0), ("02001", 3.0)]), 2024)
    day = dt.date(2024, 1, 1)
    df = stored_risk(TB.read_risk(spark, p), day, day, ["01"])
    scan = next(line for line in plan(df).split("\n") if "FileScan" in line)
    assert "annee" in scan.split("PartitionFilters: [")[1].split("]")[0] and "dep" in scan.split("PartitionFilters: [")[1]
    assert "date" in scan.split("PushedFilters: [")[1].split("]")[0]
    assert [r["insee_com"] for r in df.collect()] == ["01001"]


# ---- outlines ---------------------------------------------------------------

def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in [*points, points[0]]]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


RINGS = "array<array<struct<x:double,y:double>>>"
U = [ring((0, 0), (9, 0), (9, 9), (6, 9), (6, 3), (3, 3), (3, 9), (0, 9))]
HOLED = [box(0, 0, 9, 9), ring((3, 3), (3, 6), (6, 6), (6, 3))]
PARTS = [box(0, 0, 3, 9), box(6, 0, 9, 9)]
CASES = [
    ("notch", [box(3, 3, 6, 9)], U, False), ("foot", [box(3, 0, 6, 3)], U, True), ("leg", [box(0, 0, 3, 9)], U, True),
    ("across the notch", [box(1, 5, 8, 6)], U, False), ("itself", U, U, True), ("touching the notch", [box(1, 1, 3, 8)], U, True),
    ("hole exactly", [box(3, 3, 6, 6)], HOLED, False), ("over the hole", [box(1, 1, 8, 8)], HOLED, False),
    ("beside the hole", [box(0, 0, 3, 9)], HOLED, True), ("in the hole", [box(4, 4, 5, 5)], HOLED, False),
    ("holed in holed", [box(1, 1, 8, 8), box(2, 2, 7, 7)], HOLED, True), ("itself with hole", HOLED, HOLED, True),
    ("gap", [box(3, 1, 6, 2)], PARTS, False), ("bridge", [box(1, 1, 8, 2)], PARTS, False), ("part", [box(7, 1, 8, 2)], PARTS, True),
    ("both parts", [box(1, 1, 2, 2), box(7, 1, 8, 2)], PARTS, True), ("outside", [box(10, 0, 11, 1)], U, False),
    ("larger", [box(-1, -1, 10, 10)], U, False),
]


def test_within_for_real_outlines(spark):
    df = spark.createDataFrame([(n, a, b) for n, a, b, _ in CASES], f"n string, a {RINGS}, b {RINGS}")
    got = {r["n"]: r["w"] for r in df.select("n", rings_within(F.col("a"), F.col("b")).alias("w")).collect()}
    assert got == {n: w for n, _, _, w in CASES}


def test_area_and_centroid_of_parts_and_holes(spark):
    df = spark.createDataFrame([(HOLED,), (PARTS,)], f"r {RINGS}")
    got = [tuple(round(v, 6) for v in r) for r in df.select(*rings_area_centroid(F.col("r"))).collect()]
    assert got == [(72.0, 4.5, 4.5), (54.0, 4.5, 4.5)]


def test_parcels_of_one_commune(spark):
    zones = spark.createDataFrame([("u", U), ("h", HOLED)], f"code_insee string, ring {RINGS}")
    parcels = spark.createDataFrame([(1, box(3, 3, 6, 9)), (2, box(0, 0, 2, 2))], "id int, ring array<struct<x:double,y:double>>")
    assert [(r["id"], r["code_insee"]) for r in parcels_of_commune(parcels, zones, "u").collect()] == [(2, "u")]


def test_nearest_point_ends_by_proof(spark):
    rng = np.random.default_rng(1)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate([*rng.uniform(0, 50, (40, 2)), (1e6, 1e6), (-2e6, 3.0)])]
    st = [(f"s{i}", float(x), float(y), float(i)) for i, (x, y) in enumerate([*rng.uniform(0, 50, (9, 2)), (2e5, 0.0)])]
    P = spark.createDataFrame(pts, "k int, x double, y double")
    S = spark.createDataFrame(st, "station string, x double, y double, valeur double")
    got = {r["k"]: r["station"] for r in nearest_point(P, S, "k", "station", "valeur", 4.0).collect()}
    assert got == {k: min(st, key=lambda s: ((s[1] - x) ** 2 + (s[2] - y) ** 2, s[0]))[0] for k, x, y in pts}
    none = nearest_point(P, S.where("FALSE"), "k", "station", "valeur", 4.0).collect()
    assert len(none) == len(pts) and all(r["station"] is None for r in none)


# ---- percentiles and labels --------------------------------------------------

def test_exact_percentiles_spread_over_parts(spark):
    rng = np.random.default_rng(4)
    data = [("hot" if i % 3 else f"k{i % 7}", float(x)) for i, x in enumerate(rng.normal(size=3000).round(2))]
    data += [(None, 1.0), (None, 3.0), ("one", 5.0), ("hot", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(8)
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {r["k"]: r["p"] for r in exact_percentiles(df, "v", probs, ["k"]).collect()}
    for k in {k for k, _ in data}:
        mine = [v for q, v in data if q == k and v is not None]
        assert np.allclose(got[k], np.percentile(mine, np.array(probs) * 100)), k
    whole = exact_percentiles(df, "v", probs).collect()
    assert np.allclose(whole[0]["p"], np.percentile([v for _, v in data if v is not None], np.array(probs) * 100))
    empty = exact_percentiles(df.where("FALSE"), "v", probs).collect()
    assert [r["p"] for r in empty] == [None]


def test_top3_keyed_on_the_code(spark):
    """Two communes of one name keep their own crops and shares."""
    from driftcast.operators.crops import top3_crops
    data = [("02001", "SAINT-DENIS", 1, "C1", 10.0), ("02002", "SAINT-DENIS", 2, "C9", 170.0), ("02002", "SAINT-DENIS", 3, "C1", 30.0)]
    df = spark.createDataFrame(data, "code_insee string, nom_commune string, id_parcel int, code_cultu string, surf_parc double")
    got = {r["code_insee"]: r for r in top3_crops(df, ["code_insee", "nom_commune"]).collect()}
    assert (got["02001"]["code_cultu_1"], got["02001"]["pct_SAU_1"], got["02001"]["code_cultu_2"]) == ("C1", 100.0, None)
    assert (got["02002"]["code_cultu_1"], got["02002"]["SAU_cult_1"], got["02002"]["pct_SAU_1"]) == ("C9", 170.0, 85.0)
    assert plan(top3_crops(df, ["code_insee", "nom_commune"])).count("Scan ExistingRDD") <= 2


def test_daily_hover_text(spark):
    schema = "f boolean, d date, l int, x double, n boolean, r boolean"
    df = spark.createDataFrame([(True, dt.date(2024, 3, 5), 2, 1.23456, True, True), (False, dt.date(2024, 3, 5), None, None, None, False)],
                               T._parse_datatype_string(schema))
    got = [r[0] for r in df.select(hover_day("f", "d", "l", "x", "n", "r")).collect()]
    assert got == ["⚡ Prévision — 05/03/2024<br>Indicateur : 2<br>IFT journalier : 1.235<br>🚫 Vent fort 🌧 Pluie",
                   "05/03/2024<br>Indicateur : —<br>"]


def test_three_decimals_like_c(spark):
    from driftcast.functions.columns import three_decimals
    rng = np.random.default_rng(8)
    xs = [0.0, 0.0005, 0.0015, 0.6375, 0.0625, 2.0005, 1.9995, 12345.0625, 0.9999999, -1.2345, 1 / 3, 0.0375,
          *(i / 16 / 7 for i in range(200)), *(i / 8000 for i in range(400)), *rng.uniform(0, 50, 200).tolist()]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(three_decimals(F.col("x"))).collect()]
    assert got == [f"{x:.3f}" for x in xs]
