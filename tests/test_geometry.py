"""Literal cases for lines, polygons, bends and projection."""

import math

import numpy as np
import pytest
from conftest import make_ways
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from urbanweave.functions import frame, kernel, lines, tags
from urbanweave.operators import markings, mesh, roads

SQUARE = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]


def test_projection_known_points(spark):
    row = spark.range(1).select(
        frame.lonlat_to_utm(121.532933, 25.047453, 32651).alias("a"), frame.lonlat_to_utm(121.53296235, 25.04756678, 32651).alias("b"),
        frame.utm_epsg(121.5, 25.0).alias("n"), frame.utm_epsg(-70.0, -33.0).alias("s"),
    ).first()
    assert (row["a"]["x"], row["a"]["y"]) == (pytest.approx(352005.156, abs=1e-3), pytest.approx(2771004.448, abs=1e-3))
    assert row["b"]["x"] == pytest.approx(352008.2541932481, abs=1e-6)
    assert row["b"]["y"] == pytest.approx(2771017.017037268, abs=1e-6)
    assert (row["n"], row["s"]) == (32651, 32719)


def test_subtract_keeps_the_rest():
    cutter = [(5.0, -1.0), (20.0, -1.0), (20.0, 20.0), (5.0, 20.0)]
    assert kernel.region_area(kernel.subtract(SQUARE, cutter)) == pytest.approx(50.0)
    assert kernel.subtract(SQUARE, [(x + 10, y) for x, y in SQUARE]) == [SQUARE]
    hole = [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]
    assert kernel.region_area(kernel.subtract(SQUARE, hole)) == pytest.approx(96.0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 8), st.floats(0, 8), st.floats(0.5, 4), st.floats(0.5, 4)), min_size=1, max_size=6))
def test_difference_and_intersection_add_up(boxes):
    rings = [[(x, y), (x + w, y), (x + w, y + h), (x, y + h)] for x, y, w, h in boxes]
    union = kernel.disjoint(rings)
    left = kernel.subtract_all([SQUARE], rings)
    common = sum(0.5 * kernel.area2(kernel.clip(SQUARE, p)) for p in union)
    assert kernel.region_area(left) + common == pytest.approx(100.0, abs=1e-3)


def test_trapezoids_of_holes_and_crossings():
    hole = [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]
    assert kernel.region_area(kernel.convex_parts([SQUARE, hole])) == pytest.approx(96.0)
    bow = [(0.0, 0.0), (10.0, 10.0), (10.0, 0.0), (0.0, 10.0)]
    assert kernel.region_area(kernel.convex_parts([bow])) == pytest.approx(50.0)
    ell = [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]
    assert sum(0.5 * kernel.area2(t) for t in kernel.triangles([ell])) == pytest.approx(6.0)
    assert [kernel.area2(r) / 2 for r in kernel.odd_faces(bow)] == [25.0, 25.0]


def test_triangulate_with_hole_in_spark(spark):
    ring = lambda pts: [{"x": x, "y": y} for x, y in [*pts, pts[0]]]
    hole = [(4.0, 4.0), (6.0, 4.0), (6.0, 6.0), (4.0, 6.0)]
    schema = "id long, ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>"
    df = spark.createDataFrame([(1, ring(SQUARE), [ring(hole)]), (2, ring([(0.0, 0.0), (0.1, 0.0), (0.1, 0.1)]), [])], schema)
    parts = kernel.add(df, "parts", mesh.region_parts, "ring", "holes").select("id", "parts")
    tri = mesh.triangulate(parts)
    area = tri.groupBy("id").agg(F.sum(lines.ring_area(F.concat("t", F.slice("t", 1, 1)))).alias("a")).collect()
    assert [(r["id"], round(r["a"], 6)) for r in area] == [(1, 96.0)]


@pytest.mark.parametrize(("arms", "kind"), [
    ([0.0, math.pi, math.pi / 2], "tee"), ([0.0, math.pi / 2, math.pi, -math.pi / 2], "cross"),
    ([0.0, 2.1, -2.1], "wye"), ([0.0, math.pi], "none"), ([0.0, 1.0, 2.0, 3.0, 4.0], "complex"),
    ([0.0, 0.8, 1.6, 2.4], "irregular"),
])
def test_junction_kind(spark, arms, kind):
    df = spark.createDataFrame([(arms,)], "arms array<double>")
    assert df.select(lines.junction_kind(F.col("arms"))).first()[0] == kind


def test_dashes_and_stripes(spark):
    ways = make_ways(spark, [(1, {"highway": "residential", "width": "6"}, [(0, 0), (25, 0)]), (2, {"highway": "primary"}, [(0, 50), (100, 50)])])
    pieces = ways.withColumn("piece_no", F.lit(0)).withColumn("piece", F.col("coords"))
    pieces = pieces.withColumn("piece_widths", F.array_repeat(tags.road_width(), F.size("piece")))
    rows = markings.dash(markings.marking_lines(pieces)).collect()
    dashes = [r for r in rows if r["osm_id"] == 1]
    assert [(round(r["line"][0]["x"], 6), round(r["line"][1]["x"], 6)) for r in sorted(dashes, key=lambda r: r["seq"])] == [(0, 4), (10, 14), (20, 24)]
    second = {(r["role"], round(r["line"][0]["y"] - 50, 3)) for r in rows if r["osm_id"] == 2}
    assert second == {("center", 0.09), ("center", -0.09), ("lane", 3.0), ("lane", -3.0), ("edge", 6.0), ("edge", -6.0)}


def test_higher_rank_keeps_the_crossing(spark):
    ways = make_ways(spark, [(1, {"highway": "motorway"}, [(0, 0), (100, 0)]), (2, {"highway": "residential"}, [(50, -50), (50, 50)])])
    cut = roads.cut_by_rank(roads.pavement(ways))
    area = {r["osm_id"]: r["a"] for r in cut.select("osm_id", kernel.parts_area(F.col("parts")).alias("a")).collect()}
    assert area == {1: pytest.approx(2200.0), 2: pytest.approx(600.0 - 6 * 22)}


def test_chain_of_one_road_becomes_one_line(spark):
    road = {"highway": "primary", "name": "A"}
    ways = make_ways(spark, [
        (1, road, [(0, 0), (50, 0)]), (2, road, [(100, 0), (50, 0)]), (3, road, [(100, 0), (100, 80)]),
        (4, {"highway": "residential"}, [(50, 0), (50, 60)]), (5, {"highway": "service"}, [(500, 500), (520, 500)]),
    ])
    rows = roads.merge_chains(ways, roads.node_degree(ways)).collect()
    by_id = {r["osm_id"]: r for r in rows}
    assert set(by_id) == {3, 4, 5}
    assert [(p["x"], p["y"]) for p in by_id[3]["coords"]] == [(0, 0), (50, 0), (100, 0), (100, 80)]


def test_ring_of_ways_closes(spark):
    road = {"highway": "tertiary", "name": "Ring"}
    corners = [(0, 0), (100, 0), (100, 100), (0, 100), (0, 0)]
    ways = make_ways(spark, [(i, road, [corners[i], corners[i + 1]]) for i in range(4)])
    rows = roads.merge_chains(ways, roads.node_degree(ways)).collect()
    assert len(rows) == 1 and rows[0]["closed"] and len(rows[0]["coords"]) == 5


def test_inset_of_an_l_shape(spark):
    pts = [(0, 0), (10, 0), (10, 4), (4, 4), (4, 10), (0, 10), (0, 0)]
    ways = make_ways(spark, [(1, {"building": "yes"}, pts)])
    area = ways.select(lines.ring_area(lines.inset_ring(F.col("coords"), 0.5))).first()[0]
    assert area == pytest.approx(64 - 0.5 * 40 + 4 * 0.25, abs=1e-6)
