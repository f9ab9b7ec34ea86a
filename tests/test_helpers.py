"""Distributed helpers against plain Python references on small data."""

import math
import random

import pandas as pd
from pyspark.sql import functions as F

from driftcast.functions.aggs import exact_percentiles, n_unique, ordered_sum
from driftcast.operators.geo import nearest_point
from driftcast.operators.weather import consecutive_index


def test_exact_percentiles_match_pandas_linear(spark):
    rnd = random.Random(7)
    rows = [(g, float(rnd.randint(0, 50)) / 4) for g in ("a", "b") for _ in range(301)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["p"] for r in exact_percentiles(df, "v", (0.25, 0.5, 0.75), ["g"]).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "v"])
    for g in ("a", "b"):
        want = pdf[pdf.g == g].v.quantile([0.25, 0.5, 0.75]).tolist()
        assert all(abs(x - y) < 1e-12 for x, y in zip(got[g], want))


def test_consecutive_index_is_global_row_number(spark):
    keys = [f"k{i:05d}" for i in random.Random(3).sample(range(100000), 2500)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r["k"]: r["rn"] for r in consecutive_index(df, ["k"], partitions=7).collect()}
    assert got == {k: i + 1 for i, k in enumerate(sorted(keys))}


def test_n_unique_counts_null_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",), (None,)], "c string")
    assert df.agg(n_unique("c")).first()[0] == 3


def test_ordered_sum_is_order_free(spark):
    vals = [0.1 * i for i in range(1, 200)] + [None]
    df = spark.createDataFrame([(1, v) for v in vals], "k int, v double").repartition(7)
    got = df.groupBy("k").agg(ordered_sum("v").alias("s")).first()["s"]
    acc = 0.0
    for v in sorted(x for x in vals if x is not None):
        acc += v
    assert got == acc


def test_nearest_point_equals_brute_force(spark):
    rnd = random.Random(11)
    pts = [(f"p{i}", rnd.uniform(0, 100000), rnd.uniform(0, 100000)) for i in range(300)]
    sts = [(f"s{i}", rnd.uniform(0, 100000), rnd.uniform(0, 100000), float(i)) for i in range(40)]
    p = spark.createDataFrame(pts, "code string, x double, y double")
    s = spark.createDataFrame(sts, "station string, x double, y double, valeur double")
    got = {r["code"]: r["station"] for r in nearest_point(p, s, "code", "station", "valeur", 2000.0).collect()}
    for code, x, y in pts:
        best = min(sts, key=lambda t: (math.hypot(x - t[1], y - t[2]), t[0]))
        assert got[code] == best[0]
