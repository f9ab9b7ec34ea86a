"""Plans and helpers that must not grow faster than their tables: exploded
sides are not broadcast, small tables with large results use all tasks, and
what is computed once or in another order gives the same rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from driftcast.functions import geo as N
from driftcast.operators import geo as G
from driftcast.operators import measures as M
from driftcast.operators import risk as R
from driftcast.plans import misc_q, sources_q
from driftcast.sources import tables as TB
from driftcast.session import shared_path
from tests.conftest import SF_SMALL
from tests.test_round2 import HOLED, RINGS, box, ring

D = dt.date


def plan(df):
    """The plan as it ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


# ---- F1 to F5: joins of exploded or small sides -----------------------------------

def test_exploded_windows_are_not_broadcast(spark):
    windows = spark.createDataFrame([("01001", D(2024, 1, 1), D(2024, 1, 20)), ("01001", D(2024, 1, 1), D(2024, 1, 20))],
                                    "code_insee string, start_date date, end_date date").distinct()
    daily = spark.createDataFrame([("01001", D(2024, 1, i), float(i)) for i in range(1, 31)], "code_insee string, time date, v double")
    daily = daily.select("code_insee", "time", *[F.col("v").alias(c) for c in (
        "temperature_2m_max", "temperature_2m_min", "temperature_2m_mean", "precipitation_sum", "wind_speed_10m_max",
        "wind_speed_10m_mean", "relative_humidity_2m_max", "relative_humidity_2m_mean")])
    out = M.weather_window_aggregates(windows, daily)
    text = plan(out)
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    assert [r["precip_totale"] for r in out.collect()] == [sum(range(1, 21))]


def risk_inputs(spark):
    ift = spark.createDataFrame(
        [("01001", "1", "11", "Maïs", "Vigne", None, 8.0, 2.0, 1.0), ("01001", "1", "11", "Maïs", None, None, 4.0, None, None),
         (None, "1", "11", "Maïs", None, None, 4.0, None, None), ("01002", "1", None, "Vigne", "Vigne", "Vigne", 3.0, 3.0, 3.0)],
        "insee_com string, code_insee_dep string, code_insee_reg string, c_maj_cal string, c_ift_hbc_cal string, c_ift_h_cal string, "
        "ift_maj_hbc double, ift_hh_hbc double, ift_h double").withColumns(
        {"c_maj": F.col("c_maj_cal"), "c_ift_hbc": F.col("c_ift_hbc_cal"), "c_ift_h": F.col("c_ift_h_cal")})
    cal = spark.createDataFrame(
        [("1", "Maïs", D(2024, 3, 1), D(2024, 3, 9), True, False, False), ("1", "Maïs", None, D(2024, 3, 9), True, True, False),
         ("1", "Vigne", D(2024, 3, 1), D(2024, 3, 9), False, True, False), ("1", "Vigne", D(2024, 5, 1), D(2024, 5, 1), False, True, True)],
        "departement_code string, culture string, debut_de_periode date, fin_de_periode date, herbicides boolean, "
        "fongicides boolean, insecticides boolean")
    return R.RiskInputs(ift=ift, cal=cal, weather=None, annee=2024)


def test_period_detail_takes_the_daily_ift_of_every_row_of_its_commune(spark):
    """Repeated and null communes and periods without a start, against the
    days' table joined on (commune, day); no commune × day rows in the plan."""
    inp = risk_inputs(spark)
    days = F.array(*[F.lit(D(2024, m, 2)) for m in (3, 5)])
    daily = {}
    for r in R.daily_contributions(R.spine(R.commune_base(inp), days), 2024).collect():
        daily.setdefault((r["insee_com"], r["date"]), []).append(r["ift_journalier_total"])
    want = []
    for i in inp.ift.collect():
        for crop in dict.fromkeys(c for c in (i["c_maj_cal"], i["c_ift_hbc_cal"], i["c_ift_h_cal"]) if c):
            for c in inp.cal.where(F.col("culture") == crop).collect():
                day = c["debut_de_periode"] and c["debut_de_periode"] + dt.timedelta(1)
                found = daily.get((i["insee_com"], day), [None]) if i["insee_com"] and day else [None]
                want += [(i["insee_com"], crop, day, x) for x in found]
    out = R.period_detail(inp)
    assert sorted(map(str, want)) == sorted(str((r["insee_com"], r["culture"], r["jour_test"], r["ift_journalier_total"]))
                                            for r in out.collect())
    assert any(x for *_, x in want)
    assert "explode(Subquery" not in plan(out)


def test_small_sides_keep_all_tasks(spark):
    out = R.calendar_of_communes(risk_inputs(spark))
    assert out.count() == 10
    assert "AQEShuffleRead coalesced" not in plan(out) and "BroadcastHashJoin" not in plan(out)


# ---- F21: weather meets communes, not commune x day rows ----------------------------

def test_weather_joins_communes_before_their_days(spark):
    """The spine with weather equals the left join on (commune, day), also
    with repeated and null communes, repeated weather rows, weather of other
    days and null readings; no commune × day row is sorted or joined to it."""
    base = spark.createDataFrame([("c1", 1), ("c1", 2), ("c2", 3), (None, 4), ("c3", 5)], "insee_com string, n int")
    d = [D(2024, 1, i) for i in range(1, 8)]
    rows = [("c1", d[0], 1.0, 2.0), ("c1", d[0], 1.0, 2.0), ("c1", d[2], None, 0.5), ("c1", d[3], 9.0, 9.0), (None, d[0], 7.0, 7.0),
            ("c2", d[4], None, None), ("c2", None, 1.0, 1.0), ("c9", d[0], 1.0, 1.0), ("c1", d[6], 5.0, 5.0)]
    weather = spark.createDataFrame(rows, "code_insee string, time date, wind_speed_10m_mean double, precipitation_sum double")
    days = [d[0], d[2], d[4], d[5]]  # not d[3], which the period covers
    out = R.weather_spine(base, F.array(*map(F.lit, days)), weather, d[0], d[5])
    want = [(c, n, day, *w) for c, n in [tuple(r) for r in base.collect()] for day in days
            for w in [(a, b, True) for i, t, a, b in rows if i == c is not None and t == day] or [(None, None, None)]]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in out.select(
        "insee_com", "n", "date", "wind_speed_10m_mean", "precipitation_sum", "_met").collect())
    assert "Sort " not in plan(out) and "SortMergeJoin" not in plan(out)
    assert R.weather_spine(base, F.lit(None).cast("array<date>"), weather, d[0], d[5]).count() == 0


def test_year_is_written_without_a_folder_per_row(spark):
    out = sources_q.q_read_partitioned(spark, SF_SMALL)
    assert all("/annee=2024/" in f for f in out.inputFiles())
    assert {r["annee"] for r in out.select("annee").distinct().collect()} == {2024}
    assert out.columns == [*R.RISK_COLUMNS, "annee"]


# ---- F6 to F11: containment --------------------------------------------------------

def test_parcels_use_all_tasks(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert misc_q.parcels(spark, SF_SMALL).rdd.getNumPartitions() == n
    assert misc_q.parcels_in_parts(spark, SF_SMALL).rdd.getNumPartitions() == n


def test_prepared_outlines_agree_with_the_sides_of_edges(spark):
    """With and without what decides far from edges: random squares, slanted,
    doubled, open, empty and point rings and odd numbers."""
    rng = random.Random(5)

    def some():
        x, y, a, b = rng.randrange(10), rng.randrange(10), rng.randrange(1, 5), rng.randrange(1, 5)
        kind = rng.randrange(12)
        if kind == 0:
            return ring((x, y), (x + a, y + b), (x, y + b))
        if kind == 1:
            return box(x, y, x + a, y + b)[:-1]  # open
        if kind == 2:
            return box(x, y, x, y)
        if kind == 3:
            return []
        return box(x, y, x + a, y + b)

    odd = [[(0.0, 0.0), (float("nan"), 0.0), (1.0, 1.0), (0.0, 0.0)], [(0.0, 0.0), (float("inf"), 0.0), (1.0, 1.0), (0.0, 0.0)],
           [(0.0, 0.0), (None, 0.0), (1.0, 1.0), (0.0, 0.0)]]
    cases = [([some() for _ in range(rng.choice((1, 1, 2, 3)))], rng.choice([HOLED, [some() for _ in range(rng.choice((1, 2, 3)))]]))
             for _ in range(200)]
    cases += [([o], [box(-5, -5, 20, 20)]) for o in odd] + [([box(0, 0, 1, 1)], [o]) for o in odd]
    cases += [([box(20, 20, 21, 21)] * 2, [box(0, 0, 5, 5)]), ([box(20, 20, 21, 21)], [box(0, 0, 5, 5)]), ([], [box(0, 0, 1, 1)])]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], f"n int, a {RINGS}, b {RINGS}")
    edges = [N._boxed(N._proper(N._all_edges(F.col(c)))) for c in "ab"]
    got = df.select("n", N.rings_within(F.col("a"), F.col("b")).alias("w"),
                    N._within_by_sides(edges[0], edges[1], edges[1]).alias("slow")).collect()
    assert {True, False} <= {r["slow"] for r in got}
    assert [(r["n"], r["w"]) for r in got] == [(r["n"], r["slow"]) for r in got]


# ---- F13: nearest station ----------------------------------------------------------

def test_cells_follow_the_density_of_stations():
    assert G.first_cell(16384.0, 1e6, 1e6, 1_000_000) == pytest.approx(1000.0)
    assert G.first_cell(16384.0, 1e6, 1e6, 100) == G.first_cell(16384.0, None, None, 0) == G.first_cell(16384.0, 0.0, 5.0, 3) == 16384.0


def test_nearest_of_dense_and_lone_stations(spark):
    rng = random.Random(2)
    st = [(f"S{i}", rng.random() * 50, rng.random() * 50, float(i)) for i in range(300)] + [("T", 9000.0, 9000.0, 0.5), ("S", 1.0, 1.0, 2.0)]
    pts = [(f"p{i}", rng.random() * 60, rng.random() * 60) for i in range(40)] + [("far", 8000.0, 100.0), ("on", 1.0, 1.0)]
    out = G.nearest_point(spark.createDataFrame(pts, "k string, x double, y double"),
                          spark.createDataFrame(st, "station string, x double, y double, valeur double"), "k", "station", "valeur", 16384.0)
    want = {k: min(((((x - a) ** 2 + (y - b) ** 2) ** 0.5), s) for s, a, b, _ in st)[1] for k, x, y in pts}
    assert {r["k"]: r["station"] for r in out.collect()} == want


# ---- F17 to F19: stored tables -----------------------------------------------------

def test_weather_of_one_task_is_sorted_by_several(spark):
    df = spark.range(0, 300_000, 1, 1).select(F.format_string("%08d", F.col("id") % 3000).alias("code_insee"),
                                              F.date_add(F.lit(D(2024, 1, 1)), (F.col("id") / 3000).cast("int")).alias("time"), F.rand(1).alias("v"))
    p = shared_path(spark, "weather")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        assert TB.save_weather(df, p, 2024).first()["rows"] == 300_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(TB.read_partitioned(spark, f"{p}/historique", hive=False).inputFiles()) > 1


def test_rows_out_of_order_are_found_across_blocks(spark):
    rows = [("f", i, f"{i:05d}", D(2024, 1, 1)) for i in range(40)] + [("g", i, f"{39 - i:05d}", D(2024, 1, 1)) for i in range(3)]
    rows[16] = ("f", 16, "00015", D(2024, 1, 1))  # equal to the last of its block before
    rows[21] = ("f", 21, "00001", D(2024, 1, 1))
    df = spark.createDataFrame(rows, "f string, i bigint, insee_com string, date date")
    assert sorted(r["insee_com"] for r in sources_q.out_of_order(df, 16).collect()) == ["00001", "00015", "00037", "00038"]
