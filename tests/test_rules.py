"""Literal-row tests of every rule branch (R4, R5, E3, E4, E6) and of the
scalar helpers, nulls included."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from driftcast.functions import columns as C
from driftcast.functions.geo import lambert93_to_wgs84, ring_area_centroid, ring_bbox, ring_within
from driftcast.operators.risk import RiskInputs, risk_days


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("wind,rain,ind,flags", [
    (None, None, 1, (None, None, None, None)),
    (12.0, None, 0, (False, True, None, False)),
    (None, 3.0, 0, (None, None, True, None)),
    (4.0, 0.0, 2, (False, False, False, True)),
    (5.0, 2.0, 2, (False, False, False, True)),
    (7.0, 1.0, 1, (False, False, False, True)),
    (19.0, 0.0, 0, (True, True, False, False)),
])
def test_weather_indicator(spark, wind, rain, ind, flags):
    df = spark.createDataFrame([(wind, rain)], "wind_speed_10m_mean double, precipitation_sum double")
    r = df.select(*C.weather_indicator_cols()).first()
    assert r["indicateur_meteo"] == ind
    assert (r["interdiction_pulv"], r["traitement_deconseille"], r["pluie_limitante"],
            r["risque_dispersion"]) == flags


@pytest.mark.parametrize("x,lvl", [(None, None), (0.0, 0), (-0.0, 0), (0.5, 1), (1.0, 1), (1.5, 2),
                                   (2.0, 2), (3.0, 3), (4.0, 3), (4.5, 4), (float("inf"), 4),
                                   (float("nan"), 4)])
def test_level_0_4(spark, x, lvl):
    assert one(spark, C.level_0_4("v"), "v double", (x,)) == lvl


@pytest.mark.parametrize("num,den,out", [(1.0, 0.0, math.inf), (-1.0, 0.0, -math.inf), (0.0, 0.0, "nan"),
                                         (3.0, 2.0, 1.5), (None, 0.0, "nan-or-null")])
def test_safe_divide(spark, num, den, out):
    v = one(spark, C.safe_divide(F.col("a"), F.col("b")), "a double, b double", (num, den))
    if out == "nan":
        assert math.isnan(v)
    elif out == "nan-or-null":
        assert v is None or math.isnan(v)
    else:
        assert v == out


def test_pad_and_dep(spark):
    df = spark.createDataFrame([("1001",), ("35064",), ("2A004",), ("123456",), (None,)], "c string")
    got = [tuple(r) for r in df.select(C.pad_insee("c"), C.dep_of_insee("c")).collect()]
    assert got == [("01001", "01"), ("35064", "35"), ("2A004", "2A"), ("123456", "12"), (None, None)]


def test_parse_concentration_and_detected(spark):
    df = spark.createDataFrame([("<0.05",), ("1.5",), ("abc",), (None,)], "c string")
    got = [tuple(r) for r in df.select(C.parse_concentration("c"), C.detected("c")).collect()]
    assert got == [(0.0, False), (1.5, True), (None, True), (None, True)]


def test_yes_no(spark):
    df = spark.createDataFrame([("Oui",), ("OUI",), ("non",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(C.yes_no("c")).collect()] == [True, True, False, False, None]


def test_rebase_year_guards_feb29(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 29),), (dt.date(2023, 3, 1),)], "d date")
    got = [r[0] for r in df.select(C.rebase_year("d", 2025)).collect()]
    assert got == [None, dt.date(2025, 3, 1)]
    got = [r[0] for r in df.select(C.rebase_year("d", 2028)).collect()]
    assert got == [dt.date(2028, 2, 29), dt.date(2028, 3, 1)]


def test_month_period(spark):
    s, e = C.month_period("m", 2024)
    df = spark.createDataFrame([("Février",), ("DÉCEMBRE",), ("x",)], "m string")
    got = [tuple(r) for r in df.select(s, e).collect()]
    assert got == [(dt.date(2024, 2, 1), dt.date(2024, 2, 29)), (dt.date(2024, 12, 1), dt.date(2024, 12, 31)),
                   (None, None)]


def test_map_crop(spark):
    df = spark.createDataFrame([("Triticale",), ("Soja",), ("Tabac",), (None,)], "c string")
    assert [r[0] for r in df.select(C.map_crop("c")).collect()] == ["Céréales d'hiver", "Féverole d'hiver", None, None]


def test_days_in_year():
    assert C.days_in_year(2024) == 366 and C.days_in_year(2025) == 365 and C.days_in_year(2100) == 366


@pytest.mark.parametrize("x,y,lon,lat", [(700000.0, 6600000.0, 3.0, 46.5),
                                         (652469.02, 6862035.26, 2.35220, 48.85660)])
def test_lambert93(spark, x, y, lon, lat):
    lo, la = lambert93_to_wgs84("x", "y")
    r = spark.createDataFrame([(x, y)], "x double, y double").select(lo, la).first()
    assert abs(r[0] - lon) < 1e-4 and abs(r[1] - lat) < 1e-4


def test_ring_ops(spark):
    sq = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]
    inner = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 1.0)]
    edge = [(0.0, 0.0), (4.0, 0.0), (2.0, 2.0), (0.0, 0.0)]
    out = [(3.0, 3.0), (5.0, 3.0), (5.0, 5.0), (3.0, 3.0)]
    sch = "a array<struct<x:double,y:double>>, b array<struct<x:double,y:double>>"
    df = spark.createDataFrame([(inner, sq), (edge, sq), (out, sq)], sch)
    assert [r[0] for r in df.select(ring_within("a", "b")).collect()] == [True, True, False]
    r = df.limit(1).select(*ring_area_centroid("b"), *ring_bbox("b")).first()
    assert (r["area"], r["cx"], r["cy"]) == (16.0, 2.0, 2.0)
    assert (r["xmin"], r["ymin"], r["xmax"], r["ymax"]) == (0.0, 0.0, 4.0, 4.0)


def _inputs(spark, ift_rows, cal_rows, weather_rows, annee=2024):
    ift = spark.createDataFrame(ift_rows, "insee_com string, code_insee_dep string, code_insee_reg string, "
                                "c_maj string, ift_maj_hbc double, c_ift_hbc string, ift_hh_hbc double, c_ift_h string, "
                                "ift_h double, c_maj_cal string, c_ift_hbc_cal string, c_ift_h_cal string")
    cal = spark.createDataFrame(cal_rows, "departement_code string, culture string, debut_de_periode date, "
                                "fin_de_periode date, herbicides boolean, fongicides boolean, insecticides boolean")
    w = None
    if weather_rows is not None:
        w = spark.createDataFrame(weather_rows, "code_insee string, time date, wind_speed_10m_mean double, "
                                  "precipitation_sum double")
    return RiskInputs(ift=ift, cal=cal, weather=w, annee=annee)


D1, D2, D3 = dt.date(2024, 3, 1), dt.date(2024, 3, 2), dt.date(2024, 3, 3)


def test_contribution_branches(spark):
    # dep 10 has 2 periods of crop A (one active on D1..D2, both counted);
    # commune 1: active A -> 4/2; commune 2: crop unknown & ift 0 -> 0;
    # commune 3: ift null -> 0; commune 4: every config undetermined -> null;
    # commune 5: dep 11 absent, region mean of dep 10 -> 2.0 and regional activity
    cal = [("10", "A", D1, D2, False, True, False), ("10", "A", dt.date(2024, 6, 1), dt.date(2024, 6, 2), True, False, False)]
    ift = [("c1", "10", "R", "a", 4.0, "a", None, "a", None, "A", "A", "A"),
           ("c2", "10", "R", "z", 0.0, "z", 0.0, "z", 0.0, None, None, None),
           ("c3", "10", "R", "a", None, "a", None, "a", None, "A", "A", "A"),
           ("c4", "10", "R", "z", 3.0, "z", 1.0, "z", 2.0, None, None, None),
           ("c6", "10", "R", "z", 3.0, "z", None, "z", None, None, None, None),
           ("c5", "11", "R", "a", 8.0, "a", None, "a", None, "A", "A", "A")]
    inp = _inputs(spark, ift, cal, None)
    days = F.array(F.lit(D1), F.lit(D3))
    got = {(r["insee_com"], r["date"]): r for r in risk_days(inp, days).collect()}
    assert got[("c1", D1)]["ift_journalier_total"] == 2.0 and got[("c1", D3)]["ift_journalier_total"] == 0.0
    assert got[("c2", D1)]["ift_journalier_total"] == 0.0
    assert got[("c3", D1)]["ift_journalier_total"] == 0.0
    assert got[("c4", D1)]["ift_journalier_total"] is None and got[("c4", D1)]["risque_0_4"] is None
    # maj undetermined, but hbc/h have no IFT: they contribute 0, so the total is 0
    assert got[("c6", D1)]["ift_journalier_total"] == 0.0
    assert got[("c5", D1)]["ift_journalier_total"] == 4.0
    # no weather at all: neutral indicator 1 everywhere
    assert got[("c1", D1)]["indicateur_meteo"] == 1 and got[("c1", D1)]["risque_dispersion"] is True


def test_neutral_day_only_when_no_commune_has_weather(spark):
    cal = [("10", "A", D1, D3, False, False, False)]
    ift = [("c1", "10", "R", "a", 1.0, "a", None, "a", None, "A", "A", "A"),
           ("c2", "10", "R", "a", 1.0, "a", None, "a", None, "A", "A", "A")]
    w = [("c1", D1, 3.0, 0.0)]  # D1 covered (c2 has no row -> null), D2 not covered -> neutral
    inp = _inputs(spark, ift, cal, w)
    days = F.array(F.lit(D1), F.lit(D2))
    got = {(r["insee_com"], r["date"]): r for r in risk_days(inp, days).collect()}
    assert got[("c1", D1)]["indicateur_meteo"] == 2 and got[("c1", D1)]["risque_brut"] == 2.0
    assert got[("c2", D1)]["indicateur_meteo"] is None and got[("c2", D1)]["risque_0_4"] is None
    assert got[("c2", D2)]["indicateur_meteo"] == 1 and got[("c2", D2)]["pluie_limitante"] is False


def test_dedup_flags_and_zero_denominator(spark):
    # same calendar crop for maj and hbc -> hbc not added; h on a departement
    # with no herbicide period but regional activity (quirk Q1/Q3) -> +inf
    cal = [("10", "A", D1, D2, False, False, False), ("20", "B", D1, D2, True, False, False),
           ("10", "B", dt.date(2024, 9, 1), dt.date(2024, 9, 2), False, True, False)]
    ift = [("c1", "10", "R", "a", 2.0, "a", 5.0, "b", 1.0, "A", "A", "B"),
           ("c9", "20", "R", "b", 0.0, "b", 0.0, "b", 0.0, "B", "B", "B")]
    inp = _inputs(spark, ift, cal, None)
    got = {r["insee_com"]: r for r in risk_days(inp, F.array(F.lit(D1))).collect()}
    assert got["c1"]["ift_journalier_total"] == math.inf and got["c1"]["risque_0_4"] == 4


def test_quirk_switches(spark):
    # dep 10 has crop A but no period active on D1; dep 20 (same region) is
    # active: the reference (Q1) still takes the regional activity
    cal = [("10", "A", dt.date(2024, 6, 1), dt.date(2024, 6, 2), False, False, False),
           ("20", "A", D1, D2, False, False, False)]
    ift = [("c1", "10", "R", "a", 2.0, "a", None, "a", None, "A", "A", "A"),
           ("c2", "20", "R", "a", 2.0, "a", None, "a", None, "A", "A", "A")]
    days = F.array(F.lit(D1))
    q = _inputs(spark, ift, cal, None)
    got = {r["insee_com"]: r["ift_journalier_total"] for r in risk_days(q, days).collect()}
    assert got == {"c1": 2.0, "c2": 2.0}
    q2 = _inputs(spark, ift, cal, None)
    q2.fallback = "absent_only"
    got = {r["insee_com"]: r["ift_journalier_total"] for r in risk_days(q2, days).collect()}
    assert got == {"c1": 0.0, "c2": 2.0}
    # Q3: zero denominator with regional activity -> inf, or null when asked
    cal3 = [("10", "B", dt.date(2024, 9, 1), dt.date(2024, 9, 2), False, True, False),
            ("20", "B", D1, D2, True, False, False)]
    ift3 = [("c1", "10", "R", "z", 0.0, "z", 0.0, "b", 1.0, None, None, "B"),
            ("c9", "20", "R", "z", 0.0, "z", 0.0, "b", 0.0, None, None, "B")]
    q3 = _inputs(spark, ift3, cal3, None)
    assert {r["insee_com"]: r["ift_journalier_total"] for r in risk_days(q3, days).collect()}["c1"] == math.inf
    q4 = _inputs(spark, ift3, cal3, None)
    q4.zero_division = "null"
    # the h contribution becomes undetermined; the other two are 0, so the total is 0
    assert {r["insee_com"]: r["ift_journalier_total"] for r in risk_days(q4, days).collect()}["c1"] == 0.0
