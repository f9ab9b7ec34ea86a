"""Containment of outlines by the sides of edges: hand cases, and random
regions of half squares against sets."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from driftcast.functions import outlines
from driftcast.functions.geo import pack_rings, rings_within, unpack_rings, within_by_columns
from driftcast.operators.geo import _held_or_first, parcels_within
from tests.test_round2 import HOLED, RINGS, box, ring

BESIDE = [box(0, 0, 3, 3), box(3, 0, 6, 3)]  # two parts that share an edge
ISLAND = [box(0, 0, 9, 9), box(2, 2, 7, 7), box(4, 4, 5, 5)]  # a part in a hole
CASES = [
    ("part and hole-filling part", [box(1, 1, 2, 2), box(3, 3, 6, 6)], HOLED, False),
    ("part and part in the hole", [box(1, 1, 2, 2), box(4, 4, 5, 5)], HOLED, False),
    ("two parts beside the hole", [box(1, 1, 2, 2), box(6, 3, 8, 6)], HOLED, True),
    ("across a shared edge", [box(1, 1, 5, 2)], BESIDE, True),
    ("both sides of a shared edge", [box(0, 0, 6, 3)], BESIDE, True),
    ("parts of a whole", BESIDE, [box(0, 0, 6, 3)], True),
    ("parts of less", BESIDE, [box(0, 0, 6, 2)], False),
    ("on the island", [box(4, 4, 5, 5)], ISLAND, True),
    ("over the island", [box(3, 3, 6, 6)], ISLAND, False),
    ("island and rim", [box(4, 4, 5, 5), box(0, 0, 1, 1)], ISLAND, True),
    ("slanted hole filled", [ring((2, 0), (4, 2), (2, 4), (0, 2))], [box(-2, -2, 6, 6), ring((2, 0), (4, 2), (2, 4), (0, 2))], False),
    ("beside a slanted edge", [ring((0, 0), (4, 4), (0, 4))], [ring((0, 0), (4, 4), (4, 0))], False),
    ("on a slanted edge", [ring((1, 1), (3, 3), (3, 1))], [ring((0, 0), (4, 4), (4, 0))], True),
    ("its own copy twice is nothing", [box(0, 0, 1, 1), box(0, 0, 1, 1)], [box(5, 5, 6, 6)], True),
]


def within(spark, cases):
    df = spark.createDataFrame([(n, a, b) for n, a, b, _ in cases], f"n string, a {RINGS}, b {RINGS}")
    return {r["n"]: r["w"] for r in df.select("n", rings_within(F.col("a"), F.col("b")).alias("w")).collect()}


def test_within_by_sides(spark):
    assert within(spark, CASES) == {n: w for n, _, _, w in CASES}


def test_within_of_random_regions(spark):
    """A region is a set of half squares, each a ring of its own (so parts
    share edges), or their unit squares as one ring; within = subset."""
    rng = random.Random(3)

    def half(x, y, k):
        return ring((x, y), (x + 1, y + 1), (x + 1, y)) if k else ring((x, y), (x + 1, y + 1), (x, y + 1))

    def rings(cells):
        out = []
        for x, y, k in sorted(cells):
            if k == 0 and (x, y, 1) in cells and rng.random() < 0.5:
                out.append(box(x, y, x + 1, y + 1))
            elif not (k == 1 and out and (x, y, 0) in cells and out[-1] == box(x, y, x + 1, y + 1)):
                out.append(half(x, y, k))
        return out

    every = [(x, y, k) for x in range(4) for y in range(4) for k in (0, 1)]
    cases = []
    for i in range(150):
        outer = {c for c in every if rng.random() < 0.6}
        inner = {c for c in (outer if i % 2 else every) if rng.random() < 0.3}
        cases.append((str(i), rings(inner), rings(outer), inner <= outer))
    assert {True, False} == {w for *_, w in cases}
    assert within(spark, cases) == {n: w for n, _, _, w in cases}


def test_batches_agree_with_column_expressions(spark, monkeypatch):
    """The batch test against the expressions: random rings of several kinds,
    also when a chunk holds a few pairs of edges only."""
    rng = random.Random(11)

    def some():
        x, y, a, b = (rng.randrange(n) + 0.1 * rng.randrange(3) for n in (6, 6, 4, 4))
        return rng.choice([[(x, y), (x + a, y + b), (x, y + b), (x, y)], box(x, y, x + a + 1, y + b + 1),
                           box(x, y, x + a, y + b)[:-1], [], [(x, y)], box(x, y, x + 3, y + 3)])

    cases = [([some() for _ in range(rng.choice((1, 1, 2)))], [some() for _ in range(rng.choice((1, 2, 3)))] + [box(0, 0, 7, 7)][:i % 2])
             for i in range(150)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(cases)], f"n int, a {RINGS}, b {RINGS}").coalesce(1)
    rows = df.select("n", within_by_columns(F.col("a"), F.col("b")).alias("w")).collect()
    expected = [r["w"] for r in sorted(rows, key=lambda r: r["n"])]
    assert {True, False} == set(expected)
    t = df.orderBy("n").toArrow().combine_chunks()
    a, b = t["a"].chunk(0), t["b"].chunk(0)
    assert outlines.within(a, b).to_pylist() == expected
    assert outlines.within(a.slice(40, 30), b.slice(40, 30)).to_pylist() == expected[40:70]
    monkeypatch.setattr(outlines, "CHUNK", 7)
    assert outlines.within(a, b).to_pylist() == expected


def test_odd_numbers_are_left_to_the_expressions(spark):
    nan, one = [(0.0, 0.0), (float("nan"), 0.0), (1.0, 1.0), (0.0, 0.0)], box(0, 0, 1, 1)
    df = spark.createDataFrame([(0, [one], [one]), (1, [nan], [one]), (2, [one], [nan]), (3, None, [one]), (4, [None], [one]),
                                (5, [], []), (6, [[(0.0, None)]], [one]), (7, [box(0, 0, 1e80, 1)], [one])],
                               f"n int, a {RINGS}, b {RINGS}")
    t = df.coalesce(1).orderBy("n").toArrow().combine_chunks()
    assert outlines.within(t["a"].chunk(0), t["b"].chunk(0)).to_pylist() == [True, None, None, None, None, True, None, None]
    got = df.select("n", rings_within(F.col("a"), F.col("b")).alias("w"), within_by_columns(F.col("a"), F.col("b")).alias("e")).collect()
    assert [r["w"] for r in got] == [r["e"] for r in got]


def test_parcels_within_tests_pairs_in_batches(spark):
    """The join compares boxes only, the exact test runs on batches;
    each parcel, also a repeated or an empty one, comes once per zone or once
    without."""
    zones = spark.createDataFrame([("a", HOLED), ("b", [box(0, 0, 9, 9)]), ("c", [box(0, 0, 9, 9)]), (None, [])], f"zone string, ring {RINGS}")
    parcels = spark.createDataFrame([(1, box(1, 1, 2, 2)), (1, box(1, 1, 2, 2)), (2, box(2, 2, 7, 7)), (3, box(8, 8, 20, 20)),
                                     (3, box(8, 8, 20, 20)), (None, []), (4, box(90, 90, 91, 91))],
                                    "id int, ring array<struct<x: double, y: double>>")
    left = parcels_within(parcels, zones, ["zone"])
    expected = [(None, None), (1, "a"), (1, "a"), (1, "b"), (1, "b"), (1, "c"), (1, "c"), (2, "b"), (2, "c"), (3, None), (3, None), (4, None)]
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted(((r["id"], r["zone"]) for r in left.collect()), key=key) == expected
    inner = parcels_within(parcels, zones, ["zone"], "inner")
    assert sorted(((r["id"], r["zone"]) for r in inner.collect()), key=key) == [r for r in expected if r[1]]
    for df in (left, inner):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan
        assert not any("Join" in line and "lambda" in line for line in plan.splitlines())


def test_pairs_are_neither_shuffled_nor_sorted(spark):
    """Only parcels and zones are dealt, once; rings are packed for it."""
    zones = spark.createDataFrame([("a", HOLED), ("b", [box(0, 0, 9, 9)])], f"zone string, ring {RINGS}")
    parcels = spark.createDataFrame([(1, box(1, 1, 2, 2)), (2, box(90, 90, 91, 91)), (3, []), (4, None)],
                                    "id int, ring array<struct<x: double, y: double>>")
    for how, want in (("left", {(1, "a"), (1, "b"), (2, None), (3, None), (4, None)}), ("inner", {(1, "a"), (1, "b")})):
        out = parcels_within(parcels, zones, ["zone"], how, keep=["id"])
        assert out.columns == ["id", "zone"] and {tuple(r) for r in out.collect()} == want
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("Exchange hashpartitioning") == 2 and "Window" not in plan and "Sort " not in plan


def test_rings_packed_and_unpacked(spark):
    cases = [(0, [box(0, 0, 1, 1), []]), (1, [None, box(0, 0, 1, 1)]), (2, []), (3, None), (4, [[(1.0, None), (float("nan"), 2.0)]])]
    df = spark.createDataFrame(cases, f"n int, a {RINGS}")
    got = df.select("a", unpack_rings(pack_rings(F.col("a"))).alias("b")).collect()
    assert [str(r["a"]) for r in got] == [str(r["b"]) for r in got]


def test_a_parcel_goes_on_in_the_next_batch():
    rng = np.random.default_rng(4)
    for _ in range(200):
        groups = [rng.random(int(rng.integers(1, 6))) < 0.3 for _ in range(int(rng.integers(1, 8)))]
        rows = [(i, k, bool(h)) for i, g in enumerate(groups) for k, h in enumerate(g)]
        want = [(i, k) for i, g in enumerate(groups) for k, h in enumerate(g) if h or k == 0 and not g.any()]
        whole = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*[(i, k, i, h) for i, k, h in rows], strict=True)],
                                           names=["i", "k", "_row", "_in"])
        cuts = sorted({0, len(rows), *rng.integers(0, len(rows) + 1, 4).tolist()})
        got = [tuple(r.values()) for b in _held_or_first(whole.slice(a, z - a) for a, z in zip(cuts[:-1], cuts[1:], strict=True))
               for r in b.to_pylist()]
        assert sorted(got) == want
