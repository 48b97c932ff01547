"""Polyline and polygon geometry as Column expressions over ``array<struct<x:double,y:double>>``.

Everything here is built from higher-order functions, so rows never leave the JVM. A vertex list belongs to one
map way, which the OpenStreetMap format limits to 2000 vertices.
"""

from __future__ import annotations

import math
import re
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from urbanweave.functions import constants as K

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
LINE = T.ArrayType(POINT)
PARTS = T.ArrayType(LINE)


def pt(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; Column expressions have no other way to name a result."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def finished(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the named columns made once a row, after its filters.

    Spark copies the rule behind a column into every reader, and for an ``explode`` twice into a filter in front of it,
    which may run before the others; rows of an explode are plain columns to all of them.
    """
    rows = df.withColumn("_made", F.explode(F.array(F.struct(*names))))
    return rows.select(*[F.col(f"_made.{c}" if c in names else c) for c in df.columns])


def is_reference(value: Column) -> bool:
    """A plain column or lambda variable, which costs nothing to read again."""
    return re.fullmatch(r"[A-Za-z_][\w.]*", value._jc.toString()) is not None if hasattr(value, "_jc") else False


def bound_unless_reference(fn):
    """As ``bound``, but a plain column is read in place: the rule then compiles, where a lambda is interpreted."""
    once = bound(fn)

    @wraps(fn)
    def direct(coords: Column, *args, **kwargs) -> Column:
        return (fn if is_reference(coords) else once)(coords, *args, **kwargs)

    return direct


def bound(fn):
    """Evaluate the first argument of a geometry function once, however often the function reads it."""
    @wraps(fn)
    def once(coords: Column, *args, **kwargs) -> Column:
        return let(coords, lambda c: fn(c, *args, **kwargs))

    return once


def same_point(a: Column, b: Column) -> Column:
    return (a["x"] == b["x"]) & (a["y"] == b["y"])


def same_node(a: Column, b: Column) -> Column:
    """Equal at millimetre precision."""
    def mm(v: Column) -> Column:
        return F.bround(v * 1000)

    return (mm(a["x"]) == mm(b["x"])) & (mm(a["y"]) == mm(b["y"]))


def first(coords: Column) -> Column:
    return F.get(coords, F.lit(0))


def last(coords: Column) -> Column:
    return F.get(coords, F.size(coords) - 1)


@bound
def is_closed(coords: Column) -> Column:
    return (F.size(coords) >= 3) & same_point(first(coords), last(coords))


def hypot(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def segments(coords: Column) -> Column:
    """Consecutive vertex pairs as structs x0, y0, x1, y1, len."""

    def pair(a: Column, b: Column) -> Column:
        return F.struct(
            a["x"].alias("x0"),
            a["y"].alias("y0"),
            b["x"].alias("x1"),
            b["y"].alias("y1"),
            hypot(b["x"] - a["x"], b["y"] - a["y"]).alias("len"),
        )

    def zipped(c: Column) -> Column:
        n = F.size(c)
        return F.zip_with(F.slice(c, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(c, 2, n), pair_or_none(pair))

    return let(coords, zipped)


def pair_or_none(pair):
    """``zip_with`` pads the shorter list with nulls; keep the pair function null-safe for lists under two points."""
    return lambda a, b: F.when(a.isNotNull() & b.isNotNull(), pair(a, b))


def length(coords: Column) -> Column:
    return F.aggregate(segments(coords), F.lit(0.0), lambda acc, s: acc + F.coalesce(s["len"], F.lit(0.0)))


@bound
def stations(coords: Column) -> Column:
    """Running length at every vertex."""
    return F.aggregate(
        segments(coords),
        F.array(F.lit(0.0)),
        lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s["len"])),
    )


@bound
def point_at(coords: Column, distance: Column) -> Column:
    """Point at a running length, clamped to the ends."""
    return point_on(segments(coords), first(coords), distance)


def point_on(parts: Column, begin: Column, distance: Column) -> Column:
    """``point_at`` for a line whose segments are at hand."""
    want = F.greatest(distance, F.lit(0.0))
    start = F.struct(want.alias("rest"), begin["x"].alias("x"), begin["y"].alias("y"))

    def step(acc: Column, s: Column) -> Column:
        inside = acc["rest"] <= s["len"]
        t = F.when(s["len"] > 0, F.try_divide(acc["rest"], s["len"])).otherwise(0.0)
        return F.when(acc["rest"] < 0, acc).otherwise(
            F.struct(
                F.when(inside, F.lit(-1.0)).otherwise(acc["rest"] - s["len"]).alias("rest"),
                F.when(inside, s["x0"] + (s["x1"] - s["x0"]) * t).otherwise(s["x1"]).alias("x"),
                F.when(inside, s["y0"] + (s["y1"] - s["y0"]) * t).otherwise(s["y1"]).alias("y"),
            )
        )

    return let(F.aggregate(parts, start, step), lambda end: pt(end["x"], end["y"]))


@bound
def sub_line(coords: Column, start: Column, end: Column) -> Column:
    """Part of a line between two running lengths, with the vertices strictly between them."""
    def inside(m: Column) -> Column:
        return (m > start) & (m < end)

    def step(acc: Column, s: Column) -> Column:
        m = acc["m"] + s["len"]
        longer = F.concat(acc["inner"], F.array(pt(s["x1"], s["y1"])))
        return F.struct(m.alias("m"), F.when(inside(m), longer).otherwise(acc["inner"]).alias("inner"))

    def cut(parts: Column) -> Column:
        here = F.array(pt(first(coords)["x"], first(coords)["y"]))
        none = F.struct(F.lit(0.0).alias("m"), F.filter(here, lambda _: inside(F.lit(0.0))).alias("inner"))
        inner = F.aggregate(parts, none, step, lambda acc: acc["inner"])
        return F.concat(F.array(point_on(parts, first(coords), start)), inner, F.array(point_on(parts, first(coords), end)))

    return let(segments(coords), cut)


def sample_distances(total: Column, spacing: float) -> Column:
    """Stations every ``spacing`` metres strictly inside the line; the middle of a line not longer than that."""
    count = F.greatest(F.ceil(total / F.lit(float(spacing))) - 1, F.lit(1)).cast("int")
    many = F.transform(F.sequence(F.lit(1), count), lambda k: k * F.lit(float(spacing)))
    return F.when(total <= spacing, F.array(total * 0.5)).otherwise(F.filter(many, lambda d: d < total))


@bound
def point_and_yaw(coords: Column, distance: Column, total: Column) -> Column:
    """Point at a station and heading of the short chord around it; null where the chord has no length."""
    delta = F.least(F.lit(0.5), F.greatest(total * 0.01, F.lit(1e-3)))
    here = F.least(F.greatest(distance, F.lit(0.0)), total)
    a = point_at(coords, F.greatest(F.lit(0.0), here - delta))
    b = point_at(coords, F.least(total, here + delta))

    def located(q: Column) -> Column:
        dx, dy = q["b"]["x"] - q["a"]["x"], q["b"]["y"] - q["a"]["y"]
        yaw = F.struct(q["p"]["x"].alias("x"), q["p"]["y"].alias("y"), F.atan2(dy, dx).alias("yaw"))
        return F.when(hypot(dx, dy) >= 1e-12, yaw)

    return let(F.struct(a.alias("a"), b.alias("b"), point_at(coords, here).alias("p")), located)


# ---- angles


def angle_abs(d: Column) -> Column:
    """Size of an angle difference, wrapped into 0..pi."""
    return F.lit(math.pi) - F.abs(F.lit(math.pi) - F.pmod(F.abs(d), F.lit(2 * math.pi)))


def opposite(a: Column, b: Column, tol: float = K.OPPOSITE_TOL) -> Column:
    return angle_abs(a - b - F.lit(math.pi)) < tol


def heading(a: Column, b: Column) -> Column:
    return F.atan2(b["y"] - a["y"], b["x"] - a["x"])


@bound
def start_heading(coords: Column) -> Column:
    """Heading away from the first vertex."""
    return heading(first(coords), F.get(coords, F.lit(1)))


@bound
def end_heading(coords: Column) -> Column:
    """Heading away from the last vertex, back along the line."""
    return heading(last(coords), F.get(coords, F.size(coords) - 2))


@bound
def cluster_headings(raw: Column, tol: float = K.ARM_HEADING_TOL) -> Column:
    """First heading of every group of headings closer than the tolerance, in list order."""
    return F.aggregate(
        raw,
        F.array().cast("array<double>"),
        lambda arms, h: F.when(F.exists(arms, lambda a: angle_abs(h - a) < tol), arms).otherwise(
            F.concat(arms, F.array(h))
        ),
    )


@bound
def opposite_pairs(arms: Column) -> Column:
    """Pairs of opposite arms, each arm used once, matched in list order."""
    index = F.sequence(F.lit(0), F.greatest(F.size(arms) - 1, F.lit(0)))
    empty = F.array().cast("array<int>")

    def match(used: Column, i: Column) -> Column:
        partner = F.filter(
            index,
            lambda j: (j > i) & ~F.array_contains(used, j) & opposite(F.get(arms, i), F.get(arms, j)),
        )
        taken = F.array_contains(used, i) | (F.size(partner) == 0)
        return F.when(taken, used).otherwise(F.concat(used, F.array(i, F.get(partner, F.lit(0)))))

    return (F.size(F.aggregate(index, empty, match)) / 2).cast("int")


@bound
def junction_kind(arms: Column) -> Column:
    """tee, wye, cross, irregular, complex or none, from the outbound headings."""
    n, pairs = F.size(arms), opposite_pairs(arms)
    return (
        F.when(n <= 2, "none")
        .when(n == 3, F.when(pairs >= 1, "tee").otherwise("wye"))
        .when(n == 4, F.when(pairs >= 2, "cross").otherwise("irregular"))
        .otherwise("complex")
    )


@bound
def turn_sum(coords: Column) -> Column:
    """Total absolute turn over the inner vertices."""
    index = F.sequence(F.lit(0), F.greatest(F.size(coords) - 3, F.lit(0)))
    at = lambda i: F.get(coords, i)
    turns = F.transform(
        index, lambda i: F.coalesce(angle_abs(heading(at(i + 1), at(i + 2)) - heading(at(i), at(i + 1))), F.lit(0.0))
    )
    return F.aggregate(turns, F.lit(0.0), lambda a, b: a + b)


@bound
def looks_like_ring(coords: Column, closed: Column) -> Column:
    """Compact loop or near-loop of at least eight vertices, 40 to 900 m long."""
    total, turn = length(coords), turn_sum(coords)
    limit = F.when(closed | same_node(first(coords), last(coords)), math.radians(250.0)).otherwise(math.radians(200.0))
    return (F.size(coords) >= 8) & (total >= 40.0) & (total <= 900.0) & (turn > limit)


@bound
def bends_near(coords: Column, distance: Column, total: Column, window) -> Column:
    """The line turns by more than 16 degrees around an inner station."""
    span = F.greatest(F.lit(2.0), window if isinstance(window, Column) else F.lit(float(window)))
    d0, d1 = F.greatest(F.lit(0.0), distance - span), F.least(total, distance + span)
    mid = F.greatest(d0, F.least(d1, distance))
    three = let(segments(coords), lambda parts: F.array(*[point_on(parts, first(coords), d) for d in (d0, mid, d1)]))
    turned = let(three, lambda p: angle_abs(heading(p[1], p[2]) - heading(p[0], p[1])) > math.radians(16.0))
    inner = (total >= 2.0) & (distance >= 1.25) & (distance <= total - 1.25) & (d1 - d0 >= 1.5)
    return inner & turned


# ---- offsets and ribbons


def normals(coords: Column) -> Column:
    """Left unit normal at every vertex, from its two neighbours; straight up where they coincide."""
    def all_normals(c: Column) -> Column:
        n = F.size(c)

        def normal(_: Column, i: Column) -> Column:
            a, b = F.get(c, F.greatest(i - 1, F.lit(0))), F.get(c, F.least(i + 1, n - 1))

            def scaled(d: Column) -> Column:
                size = hypot(d["x"], d["y"])
                unit = pt(F.try_divide(-d["y"], size), F.try_divide(d["x"], size))
                return F.when(size < 1e-6, pt(F.lit(0.0), F.lit(1.0))).otherwise(unit)

            return let(pt(b["x"] - a["x"], b["y"] - a["y"]), scaled)

        return F.transform(c, normal)

    return let(coords, all_normals)


@bound
def offset_variable(coords: Column, widths: Column, fraction: float) -> Column:
    """Vertices moved along their normal by a fraction of the width there (left is positive)."""
    moved = F.zip_with(normals(coords), widths, lambda nv, w: pt(nv["x"] * w * fraction, nv["y"] * w * fraction))
    return F.zip_with(coords, moved, lambda p, m: pt(p["x"] + m["x"], p["y"] + m["y"]))


def offset_constant(coords: Column, distance: Column) -> Column:
    """Parallel line at a signed distance to the left, mitred at the bends."""
    def shifted(c: Column) -> Column:
        n = F.size(c)

        def moved(here: Column, i: Column) -> Column:
            before = _unit_normal(F.get(c, F.greatest(i - 1, F.lit(0))), F.get(c, F.greatest(i, F.lit(1))))
            after = _unit_normal(F.get(c, F.least(i, n - 2)), F.get(c, F.least(i + 1, n - 1)))
            return _mitred(here, before, after, distance, 0.2)

        return F.transform(c, moved)

    return let(coords, shifted)


def ribbon(coords: Column, widths: Column) -> Column:
    """Closed ring around a line with the given width at every vertex (at least 0.8 m)."""
    wide = F.transform(widths, lambda w: F.greatest(w, F.lit(0.8)))
    ring = F.concat(offset_variable(coords, wide, 0.5), F.reverse(offset_variable(coords, wide, -0.5)))
    return let(ring, lambda r: F.concat(r, F.slice(r, 1, 1)))


def segment_boxes(coords: Column, half: Column) -> Column:
    """Flat-ended boxes of the given half width around every segment, as closed rings; the half width is judged once a line."""
    def ring(s: Column, h: Column) -> Column:
        def around(n: Column) -> Column:
            a = pt(s["x0"] + n["x"], s["y0"] + n["y"])
            return F.array(
                a, pt(s["x0"] - n["x"], s["y0"] - n["y"]), pt(s["x1"] - n["x"], s["y1"] - n["y"]), pt(s["x1"] + n["x"], s["y1"] + n["y"]), a,
            )

        ux, uy = F.try_divide(s["x1"] - s["x0"], s["len"]), F.try_divide(s["y1"] - s["y0"], s["len"])
        return let(pt(-uy * h, ux * h), around)

    def boxes(h: Column) -> Column:
        return F.transform(F.filter(segments(coords), lambda s: s["len"] > 0), lambda s: ring(s, h))

    return boxes(half) if is_reference(half) else let(half, boxes)


def disc(center: Column, radius: Column, quadrant: int = 16) -> Column:
    """Closed ring of a regular polygon with ``4 * quadrant`` corners on the circle; centre and radius are judged once a disc."""
    steps = 4 * quadrant
    angles = [F.lit(i % steps) * (2 * math.pi / steps) for i in range(steps + 1)]
    circle = F.array(*[F.struct(F.cos(a).alias("x"), F.sin(a).alias("y")) for a in angles])  # becomes a literal

    def corners(c: Column, r: Column) -> Column:
        return F.transform(circle, lambda u: pt(c["x"] + r * u["x"], c["y"] + r * u["y"]))

    if is_reference(center) and is_reference(radius):
        return corners(center, radius)
    return let(F.struct(center.alias("c"), radius.alias("r")), lambda v: corners(v["c"], v["r"]))


@bound
def buffer_parts(coords: Column, half: Column, cap: str = "round") -> Column:
    """Convex parts that together cover the line's buffer: a box per segment, a disc per joint (and per round end)."""
    joints = coords if cap == "round" else F.slice(coords, F.lit(2), F.greatest(F.size(coords) - 2, F.lit(0)))
    return let(half, lambda h: F.concat(segment_boxes(coords, h), F.transform(joints, lambda p: disc(p, h))))


@bound
def merge_straight(coords: Column) -> Column:
    """Drop inner vertices that lie on the straight line between their neighbours."""
    n = F.size(coords)
    index = F.sequence(F.lit(0), n - 1)

    def kept(i: Column) -> Column:
        a, p, b = (F.get(coords, F.greatest(i - 1, F.lit(0))), F.get(coords, i), F.get(coords, F.least(i + 1, n - 1)))
        cross = (p["x"] - a["x"]) * (b["y"] - p["y"]) - (p["y"] - a["y"]) * (b["x"] - p["x"])
        dot = (p["x"] - a["x"]) * (b["x"] - p["x"]) + (p["y"] - a["y"]) * (b["y"] - p["y"])
        return (i == 0) | (i == n - 1) | (F.abs(cross) > 1e-9) | (dot < 0)

    return F.transform(F.filter(index, kept), lambda i: F.get(coords, i))


# ---- rings


def ring_area_signed(ring: Column) -> Column:
    return 0.5 * F.aggregate(
        segments(ring), F.lit(0.0), lambda acc, s: acc + (s["x0"] * s["y1"] - s["x1"] * s["y0"])
    )


@bound_unless_reference
def ring_area(ring: Column) -> Column:
    p, q = F.get(ring, F.lit(0)), F.get(ring, F.lit(2))
    box = F.abs(q["x"] - p["x"]) * F.abs(q["y"] - p["y"])
    return F.when(_is_box(ring), box).otherwise(F.abs(ring_area_signed(ring)))


@bound_unless_reference
def ring_centroid(ring: Column) -> Column:
    """Area centroid, computed relative to the first vertex; the vertex itself for rings without area."""
    base = first(ring)
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def step(acc: Column, s: Column) -> Column:
        x0, y0, x1, y1 = s["x0"] - base["x"], s["y0"] - base["y"], s["x1"] - base["x"], s["y1"] - base["y"]
        cross = x0 * y1 - x1 * y0
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["x"] + (x0 + x1) * cross).alias("x"),
            (acc["y"] + (y0 + y1) * cross).alias("y"),
        )

    def centre(total: Column) -> Column:
        def share(v: Column) -> Column:
            return F.coalesce(F.try_divide(v, 3 * total["a"]), F.lit(0.0))

        return pt(base["x"] + share(total["x"]), base["y"] + share(total["y"]))

    p, q = F.get(ring, F.lit(0)), F.get(ring, F.lit(2))
    middle = pt((p["x"] + q["x"]) / 2, (p["y"] + q["y"]) / 2)
    return F.when(_is_box(ring), middle).otherwise(let(F.aggregate(segments(ring), zero, step), centre))


@bound_unless_reference
def vertex_mean(coords: Column) -> Column:
    """Plain mean of the vertices; a closing vertex counts twice. Five vertices are summed without a lambda, in the same order."""
    n = F.size(coords)

    def sum_of_five(name: str) -> Column:
        total = F.lit(0.0)
        for i in range(5):
            total = total + F.get(coords, F.lit(i))[name]
        return total

    total = F.aggregate(
        coords,
        F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")),
        lambda acc, p: F.struct((acc["x"] + p["x"]).alias("x"), (acc["y"] + p["y"]).alias("y")),
    )
    plain = let(total, lambda s: pt(s["x"] / n, s["y"] / n))
    return F.when(n == 5, pt(sum_of_five("x") / n, sum_of_five("y") / n)).otherwise(plain)


def convex_hull(points: Column) -> Column:
    """Closed convex ring of points, counter-clockwise from the lowest ``x, y``; there and back for points on one line."""

    def left_turn(a: Column, b: Column, c: Column) -> Column:
        return (b["x"] - a["x"]) * (c["y"] - a["y"]) - (b["y"] - a["y"]) * (c["x"] - a["x"]) > 0

    def add(chain: Column, p: Column) -> Column:
        # the corners that a later point leaves in place are always the front ones
        stay = F.filter(chain, lambda q, i: (i == 0) | left_turn(F.get(chain, i - 1), q, p))
        return F.concat(stay, F.array(p))

    def ring(ordered: Column) -> Column:
        none = F.array().cast("array<struct<x:double,y:double>>")
        back = F.aggregate(F.reverse(ordered), none, add)
        return F.concat(F.aggregate(ordered, none, add), F.slice(back, F.lit(2), F.size(ordered)))

    return let(F.array_sort(F.array_distinct(points)), ring)


@bound_unless_reference
def bounds(c: Column) -> Column:
    xs, ys = F.transform(c, lambda p: p["x"]), F.transform(c, lambda p: p["y"])
    p, q = F.get(c, F.lit(0)), F.get(c, F.lit(2))
    box = F.struct(
        F.least(p["x"], q["x"]).alias("x0"), F.least(p["y"], q["y"]).alias("y0"),
        F.greatest(p["x"], q["x"]).alias("x1"), F.greatest(p["y"], q["y"]).alias("y1"),
    )
    general = F.struct(
        F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"),
        F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"),
    )
    return F.when(_is_box(c), box).otherwise(general)


def parts_bounds(parts: Column) -> Column:
    return bounds(F.flatten(parts))


def box_ring(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    a = pt(x0, y0)
    return F.array(a, pt(x1, y0), pt(x1, y1), pt(x0, y1), a)


def _is_box(c: Column) -> Column:
    """Four corners whose edges run along the axes in turn; plain comparisons, no lambdas."""
    p = [F.get(c, F.lit(i)) for i in range(4)]
    flat_first = (p[0]["y"] == p[1]["y"]) & (p[1]["x"] == p[2]["x"]) & (p[2]["y"] == p[3]["y"]) & (p[3]["x"] == p[0]["x"])
    tall_first = (p[0]["x"] == p[1]["x"]) & (p[1]["y"] == p[2]["y"]) & (p[2]["x"] == p[3]["x"]) & (p[3]["y"] == p[0]["y"])
    solid = (p[0]["x"] != p[2]["x"]) & (p[0]["y"] != p[2]["y"])
    return (F.size(c) == 5) & same_point(p[0], F.get(c, F.lit(4))) & (flat_first | tall_first) & solid


@bound_unless_reference
def is_box(ring: Column) -> Column:
    """The ring is an axis-aligned rectangle of four corners."""
    return _is_box(ring)


def _unit_normal(a: Column, b: Column) -> Column:
    """Left unit normal of the edge a-b, zero for an edge without length."""
    def scaled(d: Column) -> Column:
        size = hypot(d["x"], d["y"])
        return pt(F.coalesce(F.try_divide(-d["y"], size), F.lit(0.0)), F.coalesce(F.try_divide(d["x"], size), F.lit(0.0)))

    return let(pt(b["x"] - a["x"], b["y"] - a["y"]), scaled)


def _mitred(here: Column, before: Column, after: Column, distance: Column, floor: float) -> Column:
    """Point on both parallels of the edges around a vertex; |s|^2 / 2 = 1 + cos(turn), bounded for sharp turns."""
    def moved(s: Column) -> Column:
        scale = F.try_divide(2 * distance, F.greatest(s["x"] * s["x"] + s["y"] * s["y"], F.lit(floor)))
        return pt(here["x"] + s["x"] * scale, here["y"] + s["y"] * scale)

    return let(F.struct(before.alias("b"), after.alias("a")),
               lambda n: let(pt(n["b"]["x"] + n["a"]["x"], n["b"]["y"] + n["a"]["y"]), moved))


@bound_unless_reference
def inset_ring(ring: Column, distance: float) -> Column:
    """Closed ring with every edge moved inwards by ``distance``, corners mitred; null when nothing is left."""
    def inner(body: Column) -> Column:
        n = F.size(body)
        signed = F.lit(float(distance)) * F.signum(ring_area_signed(ring))

        def moved(here: Column, i: Column) -> Column:
            before = _unit_normal(F.get(body, F.pmod(i - 1, n)), here)
            after = _unit_normal(here, F.get(body, F.pmod(i + 1, n)))
            return _mitred(here, before, after, signed, 0.02)

        return let(F.transform(body, moved), lambda r: F.concat(r, F.slice(r, 1, 1)))

    def checked(closed: Column) -> Column:
        area, new_area = ring_area_signed(ring), ring_area_signed(closed)
        forward = F.forall(
            F.zip_with(
                segments(ring), segments(closed),
                lambda a, b: (a["x1"] - a["x0"]) * (b["x1"] - b["x0"]) + (a["y1"] - a["y0"]) * (b["y1"] - b["y0"]),
            ),
            lambda dot: dot >= 0,
        )
        smaller = let(F.struct(area.alias("a"), new_area.alias("b")),
                      lambda v: (v["a"] * v["b"] > 0) & (F.abs(v["b"]) < F.abs(v["a"])))
        return F.when((F.size(closed) >= 4) & smaller & forward, closed)

    # a rectangle moves its corners towards the middle
    p, q = F.get(ring, F.lit(0)), F.get(ring, F.lit(2))
    cx, cy = (p["x"] + q["x"]) / 2, (p["y"] + q["y"]) / 2
    moved_in = lambda c: pt(c["x"] + distance * F.signum(cx - c["x"]), c["y"] + distance * F.signum(cy - c["y"]))
    corners = F.array(*[moved_in(F.get(ring, F.lit(i))) for i in range(5)])
    wide = (F.abs(q["x"] - p["x"]) > 2 * distance) & (F.abs(q["y"] - p["y"]) > 2 * distance)
    general = let(let(F.slice(ring, F.lit(1), F.size(ring) - 1), inner), checked)
    return F.when(_is_box(ring), F.when(wide, corners)).otherwise(general)


def point_in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Even-odd test."""
    crossings = F.aggregate(
        segments(ring),
        F.lit(0),
        lambda acc, s: acc
        + F.when(
            ((s["y0"] > y) != (s["y1"] > y))
            & (x < s["x0"] + F.coalesce(F.try_divide((y - s["y0"]) * (s["x1"] - s["x0"]), s["y1"] - s["y0"]), F.lit(0.0))),
            1,
        ).otherwise(0),
    )
    return F.pmod(crossings, F.lit(2)) == 1


def point_segment_distance(x: Column, y: Column, s: Column) -> Column:
    dx, dy = s["x1"] - s["x0"], s["y1"] - s["y0"]
    t = F.coalesce(F.try_divide((x - s["x0"]) * dx + (y - s["y0"]) * dy, dx * dx + dy * dy), F.lit(0.0))
    t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return let(t, lambda v: hypot(x - (s["x0"] + v * dx), y - (s["y0"] + v * dy)))


def segment_distance(a: Column, b: Column) -> Column:
    """Distance of two segments, zero when they meet."""
    def side(s: Column, x: Column, y: Column) -> Column:
        return (s["x1"] - s["x0"]) * (y - s["y0"]) - (s["y1"] - s["y0"]) * (x - s["x0"])

    crossed = (side(a, b["x0"], b["y0"]) * side(a, b["x1"], b["y1"]) < 0) & (
        side(b, a["x0"], a["y0"]) * side(b, a["x1"], a["y1"]) < 0
    )
    apart = F.least(
        point_segment_distance(a["x0"], a["y0"], b),
        point_segment_distance(a["x1"], a["y1"], b),
        point_segment_distance(b["x0"], b["y0"], a),
        point_segment_distance(b["x1"], b["y1"], a),
    )
    return F.when(crossed, F.lit(0.0)).otherwise(apart)


@bound
def ring_segment_distance(ring: Column, s: Column) -> Column:
    """Distance of a filled ring from a segment, zero when they touch or the segment lies inside."""
    to_edges = F.array_min(F.transform(segments(ring), lambda e: segment_distance(e, s)))
    return F.when(point_in_ring(s["x0"], s["y0"], ring), F.lit(0.0)).otherwise(to_edges)
