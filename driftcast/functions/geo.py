"""Geometry as Column expressions (B17, L1, L2, L4, L5): no geometry type,
rings are ``array<struct<x: double, y: double>>``."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from driftcast.config import L93_C, L93_E, L93_LON0_DEG, L93_N, L93_XS, L93_YS
from driftcast.functions import outlines
from driftcast.functions.columns import col_or

ITERATIONS = 6


def lambert93_to_wgs84(x: str | Column, y: str | Column) -> tuple[Column, Column]:
    """Inverse Lambert conformal conic (EPSG:2154 -> 4326), closed form
    with the isometric-latitude inverse unrolled ``ITERATIONS`` times:
    phi <- 2 atan(exp(L + e atanh(e sin phi))) - pi/2."""
    dx = col_or(x) - F.lit(L93_XS)
    dy = F.lit(L93_YS) - col_or(y)
    r = F.sqrt(dx * dx + dy * dy)
    gamma = F.atan(dx / dy)
    lon = F.lit(L93_LON0_DEG) + F.degrees(gamma / F.lit(L93_N))
    big_l = F.lit(-1.0 / L93_N) * F.log(F.abs(r / F.lit(L93_C)))
    phi = F.lit(2.0) * F.atan(F.exp(big_l)) - F.lit(math.pi / 2)
    for _ in range(ITERATIONS):
        phi = (F.lit(2.0) * F.atan(F.exp(big_l + F.lit(L93_E) * F.atanh(F.lit(L93_E) * F.sin(phi))))
               - F.lit(math.pi / 2))
    return lon, F.degrees(phi)


def lambert93_sql(x: str, y: str) -> tuple[str, str]:
    """The same formula as SQL text (oracles)."""
    dx = f"({x} - {L93_XS})"
    dy = f"({L93_YS} - {y})"
    lon = f"({L93_LON0_DEG} + degrees(atan({dx} / {dy}) / {L93_N}))"
    big_l = f"({-1.0 / L93_N} * ln(abs(sqrt({dx} * {dx} + {dy} * {dy}) / {L93_C})))"
    phi = f"(2.0 * atan(exp({big_l})) - {math.pi / 2})"
    for _ in range(ITERATIONS):
        phi = f"(2.0 * atan(exp({big_l} + {L93_E} * atanh({L93_E} * sin({phi})))) - {math.pi / 2})"
    return lon, f"degrees({phi})"


def as_rings(df: DataFrame, col: str) -> Column:
    """An outline as an array of rings: the column itself, or a single ring
    wrapped. Rings follow the even-odd rule, so parts and holes are further
    rings (for areas, holes run against their part's direction)."""
    single = isinstance(df.schema[col].dataType.elementType, T.StructType)
    return F.array(F.col(col)) if single else F.col(col)


def pack_rings(rings: Column) -> Column:
    """Rings as x, y, x, y, …: half the bytes of points in a shuffle."""
    return F.transform(rings, lambda r: F.flatten(F.transform(r, lambda p: F.array(p["x"], p["y"]))))


def unpack_rings(packed: Column) -> Column:
    """The rings again (a null point has null coordinates)."""
    def points(r):
        return F.transform(F.sequence(F.lit(1), F.size(r), F.lit(2)), lambda i: F.struct(
            F.element_at(r, i).alias("x"), F.element_at(r, i + 1).alias("y")))

    none = F.array().cast("array<struct<x:double,y:double>>")
    return F.transform(packed, lambda r: F.when(F.size(r) > 0, points(r)).when(r.isNotNull(), none))


def ring_bbox(ring: str | Column) -> list[Column]:
    """L2: bounding box of a ring."""
    return rings_bbox(F.array(col_or(ring)))


def rings_bbox(rings: Column) -> list[Column]:
    """L2: bounding box of an outline."""
    p = F.flatten(rings)
    return [F.array_min(F.transform(p, lambda p: p["x"])).alias("xmin"),
            F.array_min(F.transform(p, lambda p: p["y"])).alias("ymin"),
            F.array_max(F.transform(p, lambda p: p["x"])).alias("xmax"),
            F.array_max(F.transform(p, lambda p: p["y"])).alias("ymax")]


def _edges(ring: Column) -> Column:
    """Edges (p_i, p_{i+1}) of a closed ring (last point == first point)."""
    n = F.size(ring)
    edges = F.transform(F.sequence(F.lit(1), n - 1),
                        lambda i: F.struct(F.element_at(ring, i).alias("a"),
                                           F.element_at(ring, i + 1).alias("b")))
    # fewer than two points: no edge (and no backwards sequence)
    return F.when(n >= 2, edges).otherwise(F.array().cast(
        "array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>"))


def _all_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, _edges))


def ring_area_centroid(ring: str | Column) -> list[Column]:
    """L1 of a single ring."""
    return rings_area_centroid(F.array(col_or(ring)))


def rings_area_centroid(rings: Column) -> list[Column]:
    """L1: signed shoelace area and centroid of an outline (parts add, holes
    subtract), in coordinates relative to the first vertex (keeps the
    products small, so planar metres stay exact)."""
    first = F.try_element_at(F.flatten(rings), F.lit(1))
    x0, y0 = first["x"], first["y"]
    e = _all_edges(rings)

    def cross(s):
        return ((s["a"]["x"] - x0) * (s["b"]["y"] - y0) - (s["b"]["x"] - x0) * (s["a"]["y"] - y0))

    a2 = F.aggregate(F.transform(e, cross), F.lit(0.0), lambda acc, v: acc + v)
    cx = F.aggregate(F.transform(e, lambda s: (s["a"]["x"] + s["b"]["x"] - 2 * x0) * cross(s)),
                     F.lit(0.0), lambda acc, v: acc + v)
    cy = F.aggregate(F.transform(e, lambda s: (s["a"]["y"] + s["b"]["y"] - 2 * y0) * cross(s)),
                     F.lit(0.0), lambda acc, v: acc + v)
    return [(a2 / 2).alias("area"), (x0 + cx / (3 * a2)).alias("cx"), (y0 + cy / (3 * a2)).alias("cy")]


def _inside(px: Column, py: Column, e: Column) -> Column:
    """Crossing-number test against edges; on an edge counts as inside."""

    def on_edge(s):
        ax, ay, bx, by = s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]
        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        return ((cross == 0) & (px >= F.least(ax, bx)) & (px <= F.greatest(ax, bx))
                & (py >= F.least(ay, by)) & (py <= F.greatest(ay, by)))

    def crosses(s):
        ax, ay, bx, by = s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"]
        straddle = (ay > py) != (by > py)
        xint = ax + (py - ay) * (bx - ax) / F.when(by == ay, F.lit(1.0)).otherwise(by - ay)
        return straddle & (px < xint)

    n_cross = F.aggregate(F.transform(e, lambda s: F.when(crosses(s), 1).otherwise(0)),
                          F.lit(0), lambda acc, v: acc + v)
    return F.exists(e, on_edge) | (n_cross % 2 == 1)


def point_in_ring(px: Column, py: Column, ring: str | Column) -> Column:
    """Point in a ring; a point on the boundary counts as inside."""
    return _inside(px, py, _edges(col_or(ring)))


def point_in_rings(px: Column, py: Column, rings: Column) -> Column:
    """Point in an outline with parts and holes; the boundary is inside."""
    return _inside(px, py, _all_edges(rings))


def _contacts(s: Column, edges: Column) -> Column:
    """Where a segment meets the edges, as sorted distinct parameters in
    [0, 1] with both ends: crossings, touches, and the ends of collinear
    overlaps."""
    dx, dy = s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]
    length2 = dx * dx + dy * dy

    def meets(t):
        ex, ey = t["b"]["x"] - t["a"]["x"], t["b"]["y"] - t["a"]["y"]
        ax, ay = t["a"]["x"] - s["a"]["x"], t["a"]["y"] - s["a"]["y"]
        det = dx * ey - dy * ex
        u, v = (ax * ey - ay * ex) / F.when(det != 0, det), (ax * dy - ay * dx) / F.when(det != 0, det)
        crossing = F.when((v >= 0) & (v <= 1), u)
        collinear = (det == 0) & (ax * dy - ay * dx == 0)
        bx, by = t["b"]["x"] - s["a"]["x"], t["b"]["y"] - s["a"]["y"]
        return F.array(crossing, F.when(collinear, (ax * dx + ay * dy) / length2),
                       F.when(collinear, (bx * dx + by * dy) / length2))

    found = F.filter(F.flatten(F.transform(edges, meets)), lambda u: u.isNotNull() & (u > 0) & (u < 1))
    return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), found)))


def ring_within(inner: str | Column, outer: str | Column) -> Column:
    """L3 of single rings."""
    return rings_within(F.array(col_or(inner)), F.array(col_or(outer)))


@F.arrow_udf(T.BooleanType())
def _within_batch(inner: pa.Array, outer: pa.Array) -> pa.Array:
    return outlines.within(inner, outer)


def rings_within(inner: Column, outer: Column) -> Column:
    """L3: ``inner`` lies in ``outer`` (shared boundary allowed), for concave
    outlines, parts and holes (even-odd rule). Decided for a batch of pairs at
    once; pairs with odd numbers (null, not finite) by column expressions."""
    return F.coalesce(_within_batch(inner, outer), within_by_columns(inner, outer))


def within_by_columns(inner: Column, outer: Column) -> Column:
    """``rings_within`` as one expression."""
    return _let(inner_outline(inner), lambda i: _let(outer_outline(outer), lambda o: outline_within(inner, i, o)))


def inner_outline(rings: Column) -> Column:
    """What ``outline_within`` asks of the inner outline, apart from its rings:
    ``rings`` with their box, a vertex, and ``sure``, whether the outline has
    area in the box (the ring has, and no other ring's box meets it);
    ``whole``, whether all rings are closed and finite."""
    def area(e):
        return F.exists(e, lambda s: F.exists(_middles(s, e), lambda u: _let(
            _sides(s, u, e), lambda d: d["plus"] != d["minus"])))

    def parted(spans):  # two edges with nothing but the ring between them
        a, b = F.get(spans, F.lit(0)), F.get(spans, F.lit(1))
        return (F.size(spans) == 2) & ((F.greatest(a["a"]["x"], a["b"]["x"]) < F.least(b["a"]["x"], b["b"]["x"]))
                                       | (F.greatest(b["a"]["x"], b["b"]["x"]) < F.least(a["a"]["x"], a["b"]["x"])))

    def has_area(edges, middle):  # by one line through it, or by its edges
        return F.when(_let(F.filter(edges, lambda s: (s["a"]["y"] > middle) != (s["b"]["y"] > middle)), parted), True).otherwise(
            area(edges))

    def described(r):
        x, y = F.transform(r, lambda p: p["x"]), F.transform(r, lambda p: p["y"])
        return _let(F.struct(F.array_min(x).alias("x0"), F.array_min(y).alias("y0"), F.array_max(x).alias("x1"),
                             F.array_max(y).alias("y1")), lambda b: F.struct(
            b["x0"].alias("x0"), b["y0"].alias("y0"), b["x1"].alias("x1"), b["y1"].alias("y1"),
            F.get(r, F.lit(0))["y"].alias("py"),
            _let(_proper(_edges(r)), lambda e: has_area(e, (b["y0"] + b["y1"]) / 2)).alias("area")))

    def alone(r, i, boxes):
        return ~F.exists(F.filter(boxes, lambda q, j: (j != i) & _meets(q, r)), lambda q: F.lit(True))

    boxed = _let(F.transform(F.filter(rings, lambda r: F.size(r) > 0), described), lambda boxes: F.transform(
        boxes, lambda r, i: F.struct(r["x0"].alias("x0"), r["y0"].alias("y0"), r["x1"].alias("x1"), r["y1"].alias("y1"),
                                     r["py"].alias("py"), (r["area"] & alone(r, i, boxes)).alias("sure"))))
    return F.struct(boxed.alias("rings"), _whole(rings).alias("whole"))


def outer_outline(rings: Column) -> Column:
    """What ``outline_within`` asks of the outer outline: its ``edges`` with
    their boxes, and ``whole`` as above."""
    return F.struct(_boxed(_proper(_all_edges(rings))).alias("edges"), _whole(rings).alias("whole"))


def outline_within(rings: Column, inner: Column, outer: Column) -> Column:
    """``rings_within`` of an outline's rings and both descriptions, which a
    join computes once per row and not once per pair.

    A ring whose box no edge of ``outer`` meets lies on one side of it as a
    whole: where all rings are inside, so is the outline; where one that surely
    has area is outside, it is not. Edges are only split for the rest."""
    def side(r):  # 1 inside, 0 outside, -1 an edge is near
        return F.aggregate(outer["edges"], F.lit(0), lambda acc, e: F.when(acc < 0, acc).when(_meets(e, r), -1).when(
            ((e["a"]["y"] > r["py"]) != (e["b"]["y"] > r["py"])) & (e["x0"] > r["x1"]), 1 - acc).otherwise(acc))

    whole = inner["whole"] & outer["whole"]
    near = F.when(whole, F.filter(outer["edges"], lambda e: F.exists(inner["rings"], lambda r: _meets(e, r)))).otherwise(
        outer["edges"])
    return _let(F.transform(inner["rings"], lambda r: F.struct(side(r).alias("side"), r["sure"].alias("sure"))), lambda sides: (
        F.when(whole & F.forall(sides, lambda r: r["side"] == 1), True)
        .when(whole & F.exists(sides, lambda r: (r["side"] == 0) & r["sure"]), False)
        .otherwise(_within_by_sides(_boxed(_proper(_all_edges(rings))), outer["edges"], near))))


def _meets(a: Column, b: Column) -> Column:
    """Whether two boxes meet."""
    return (a["x1"] >= b["x0"]) & (a["x0"] <= b["x1"]) & (a["y1"] >= b["y0"]) & (a["y0"] <= b["y1"])


def _boxed(edges: Column) -> Column:
    return F.transform(edges, lambda s: F.struct(
        s["a"].alias("a"), s["b"].alias("b"),
        F.least(s["a"]["x"], s["b"]["x"]).alias("x0"), F.least(s["a"]["y"], s["b"]["y"]).alias("y0"),
        F.greatest(s["a"]["x"], s["b"]["x"]).alias("x1"), F.greatest(s["a"]["y"], s["b"]["y"]).alias("y1")))


def _whole(rings: Column) -> Column:
    """Whether all rings are closed, of finite numbers."""
    def closed(r):
        a, b = F.get(r, F.lit(0)), F.get(r, F.size(r) - 1)
        return (a["x"] == b["x"]) & (a["y"] == b["y"])

    return F.forall(rings, lambda r: (F.size(r) == 0) | closed(r) & F.forall(
        r, lambda p: (p["x"] - p["x"] == 0) & (p["y"] - p["y"] == 0)))


def _within_by_sides(own: Column, other: Column, near: Column) -> Column:
    """L3 by the sides of edges; ``near`` are the edges of ``other`` that can
    meet ``own``.

    All edges are split where they meet. Where something of the inner outline
    sticks out of the outer, that piece of plane has a border, which is a piece
    of an edge of one of them, and beside it the inner is there and the outer
    is not. So it is within exactly if no side of any piece has the one without
    the other: also where edges coincide (a part that fills a hole runs along
    it, but on the wrong side), for every part, and across an edge that two
    parts of the outer share."""
    def decide(g):
        def sticks_out(s, u):
            return _let(F.struct(_sides(s, u, g["own"]).alias("i"), _sides(s, u, g["other"]).alias("o")),
                        lambda d: (d["i"]["plus"] & ~d["o"]["plus"]) | (d["i"]["minus"] & ~d["o"]["minus"]))

        def piece_out(s):
            return F.exists(_middles(s, g["both"]), lambda u: sticks_out(s, u))

        def through(s):  # an edge of the outer that runs through the inside of the inner
            return F.exists(_middles(s, g["own"]), lambda u: _let(_sides(s, u, g["own"]), lambda d: d["plus"] & d["minus"]))

        return ~F.exists(g["own"], piece_out) & ~F.exists(g["near"], lambda s: through(s) & piece_out(s))

    return _let(F.struct(own.alias("own"), other.alias("other"), near.alias("near")), lambda g: _let(
        F.struct(g["own"].alias("own"), g["other"].alias("other"), g["near"].alias("near"),
                 F.concat(g["own"], g["near"]).alias("both")), decide))


def _let(value: Column, body) -> Column:
    """``body`` of a value computed once: inside lambdas an expression would
    be computed again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _proper(edges: Column) -> Column:
    """Edges of some length."""
    return F.filter(edges, lambda s: (s["a"]["x"] != s["b"]["x"]) | (s["a"]["y"] != s["b"]["y"]))


def _middles(s: Column, edges: Column) -> Column:
    """The middles (as parameters) of the pieces into which ``edges`` cut a
    segment."""
    return _let(_contacts(s, edges), lambda at: F.transform(
        F.sequence(F.lit(1), F.size(at) - 1), lambda i: (F.element_at(at, i) + F.element_at(at, i + 1)) / 2))


def _sides(s: Column, u: Column, edges: Column) -> Column:
    """Whether the outline of ``edges`` lies on either side of the segment at
    ``u``, a point where only edges along the segment pass: ``plus`` towards
    larger x (larger y beside a flat segment), ``minus`` the other way. A ray
    to that side crosses the edges beyond; back over the segment, it crosses
    those along it, too."""
    ax, ay = s["a"]["x"], s["a"]["y"]
    dx, dy = s["b"]["x"] - ax, s["b"]["y"] - ay
    px, py = ax + u * dx, ay + u * dy
    steep = F.abs(dy) >= F.abs(dx)

    def along(t):
        return ((dx * (t["a"]["y"] - ay) - dy * (t["a"]["x"] - ax) == 0)
                & (dx * (t["b"]["y"] - ay) - dy * (t["b"]["x"] - ax) == 0))

    def spans(t):
        return F.when(steep, (t["a"]["y"] > py) != (t["b"]["y"] > py)).otherwise((t["a"]["x"] > px) != (t["b"]["x"] > px))

    def beyond(t):
        tx, ty = t["b"]["x"] - t["a"]["x"], t["b"]["y"] - t["a"]["y"]
        return F.when(steep, t["a"]["x"] + (py - t["a"]["y"]) * tx / F.when(ty != 0, ty).otherwise(1.0) > px).otherwise(
            t["a"]["y"] + (px - t["a"]["x"]) * ty / F.when(tx != 0, tx).otherwise(1.0) > py)

    def count(met):
        ahead = F.size(F.filter(met, lambda t: ~along(t) & beyond(t)))
        under = F.size(F.filter(met, along))
        return _let(F.struct(ahead.alias("ahead"), under.alias("under")), lambda n: F.struct(
            (n["ahead"] % 2 == 1).alias("plus"), ((n["ahead"] + n["under"]) % 2 == 1).alias("minus")))

    return _let(F.filter(edges, spans), count)
