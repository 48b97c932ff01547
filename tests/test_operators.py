"""Brute-force and literal checks of the operators that have no SQL twin, and of the sources."""

import itertools
import random
import struct
import zlib

import numpy as np
import pytest
from conftest import make_ways
from pyspark.sql import functions as F

from urbanweave.functions import frame, lines
from urbanweave.operators import buildings, junctions, overlay, raster, roads, spatial
from urbanweave.plans import city
from urbanweave.sources import catalog, osm_read, pgm


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def test_components_match_union_find(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(120)]
    got = {r["node"]: r["component"] for r in spatial.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    looped = {n for a, b in edges if a == b for n in (a,)} - {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: find(n) for n in root if n not in looped}


def test_box_join_splits_dense_cells_without_losing_pairs(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.uniform(0, 90), rnd.uniform(0, 90), rnd.uniform(0.1, 3)) for i in range(400)]
    rows += [(1000 + i, rnd.uniform(-500, 500), rnd.uniform(-500, 500), rnd.uniform(1, 150)) for i in range(60)]
    df = spark.createDataFrame([(i, x, y, x + s, y + s) for i, x, y, s in rows], "id long, x0 double, y0 double, x1 double, y1 double")
    got = spatial.box_join(df.withColumnRenamed("id", "a"), df.withColumnRenamed("id", "b"), 100.0, dense_rows=20).select("a", "b").collect()
    want = {(i, j) for (i, xi, yi, si), (j, xj, yj, sj) in itertools.product(rows, rows)
            if xi <= xj + sj and xj <= xi + si and yi <= yj + sj and yj <= yi + si}
    assert len(got) == len(want) and {(r["a"], r["b"]) for r in got} == want


def reference_drop(rects):
    """One pass in file order over rectangles."""
    area = [(r[2] - r[0]) * (r[3] - r[1]) for r in rects]
    keep = [True] * len(rects)
    for i, a in enumerate(rects):
        for j, b in enumerate(rects):
            if i == j or not keep[j] or area[j] < area[i] - 1e-6:
                continue
            w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
            if w <= 0 or h <= 0 or w * h / area[i] < 0.85:
                continue
            if area[j] > area[i] + 1e-6 or j < i:
                keep[i] = False
                break
    return [i for i, k in enumerate(keep) if not k]


@pytest.mark.parametrize("seed", [1, 2])
def test_enclosed_matches_one_pass(spark, seed):
    rnd = random.Random(seed)
    rects = []
    for _ in range(160):
        x, y = rnd.randrange(0, 60), rnd.randrange(0, 60)
        rects.append((x, y, x + rnd.randrange(8, 12), y + rnd.randrange(8, 12)))
    rects += rnd.sample(rects, 60) + [rects[0]] * 20
    ways = make_ways(spark, [(i, {"building": "yes"}, box(*r)) for i, r in enumerate(rects)])
    items = ways.select("osm_id", "ord", F.col("coords").alias("ring"), lines.ring_area(F.col("coords")).alias("area"))
    got = sorted(r["osm_id"] for r in buildings.enclosed_ids(items).collect())
    assert got == reference_drop(rects)


def test_buildings_on_the_road_are_dropped(spark):
    ways = make_ways(spark, [
        (1, {"highway": "primary"}, [(-100, 0), (100, 0)]), (2, {"building": "yes"}, box(-10, -20, 10, 20)),
        (3, {"building": "yes"}, box(-10, 5, 10, 30)), (4, {"building": "yes"}, box(20, 7, 40, 30)),
        (5, {"highway": "footway"}, [(60, 0), (60, 100)]), (6, {"building": "yes"}, box(55, 40, 65, 50)),
        (7, {"building": "yes"}, box(22, 9, 38, 28)), (8, {"building": "yes"}, box(200, 200, 201, 201)),
    ])
    assert sorted(r["osm_id"] for r in buildings.build(ways).select("osm_id").collect()) == [4, 6]


def test_junction_types_and_zebra(spark):
    p = {"highway": "primary"}
    ways = make_ways(spark, [
        (1, p, [(-50, 0), (0, 0), (50, 0)]), (2, p, [(0, 0), (0, 50)]),
        (3, p, [(950, 0), (1000, 0), (1050, 0)]), (4, p, [(1000, -50), (1000, 0), (1000, 50)]),
        (5, {"highway": "residential"}, [(0, 0), (30, -40)]),
    ])
    found = junctions.typed_junctions(ways.where("osm_id <> 5"), roads.node_degree(ways.where("osm_id <> 5")))
    assert sorted((r["kind"], r["x"]) for r in found.collect()) == [("cross", 1000.0), ("tee", 0.0)]
    stripes = junctions.zebra_stripes(found).groupBy("cluster").count().collect()
    assert sorted(r["count"] for r in stripes) == [5, 20]


def test_dual_carriageways_meet_in_one_cross(spark):
    p = {"highway": "primary"}
    circle = [(500 + 20 * np.cos(k * np.pi / 4), 20 * np.sin(k * np.pi / 4)) for k in range(8)]
    ways = make_ways(spark, [
        (1, p, [(76, 16), (16, 16), (0, 16), (-60, 16)]), (2, p, [(-60, 0), (0, 0), (16, 0), (76, 0)]),
        (3, p, [(0, 76), (0, 16), (0, 0), (0, -60)]), (4, p, [(16, -60), (16, 0), (16, 16), (16, 76)]),
        (5, p | {"junction": "roundabout"}, [(float(x), float(y)) for x, y in [*circle, circle[0]]]),
    ])
    found = junctions.typed_junctions(ways, roads.node_degree(ways))
    got = {r["kind"]: r for r in found.collect()}
    assert sorted(got) == ["cross", "roundabout"] and (got["cross"]["x"], got["cross"]["y"]) == (8.0, 8.0)
    # the node that way 1 visits first gives the first arms
    assert got["cross"]["arms"] == pytest.approx([0.0, np.pi, -np.pi / 2, np.pi / 2])
    assert [(n["x"], n["y"]) for n in got["cross"]["nodes"]] == [(16.0, 16.0), (0.0, 16.0), (0.0, 0.0), (16.0, 0.0)]
    assert junctions.zebra_stripes(found).count() == 20
    spots = [(0, 8.0, 8.0), (1, 8.0, -2.0), (2, 8.0, 40.0), (3, 40.0, 8.0), (4, 520.0, 0.0)]
    spots = spark.createDataFrame([(k, 0, 0, x, y) for k, x, y in spots], "ord long, pos int, step int, x double, y double")
    assert sorted(r["ord"] for r in junctions.outside_areas(spots, found).collect()) == [2, 3]


def test_convex_hull_matches_half_planes(spark):
    rnd = random.Random(12)
    sets = [[(rnd.randrange(7), rnd.randrange(7)) for _ in range(n)] for n in range(1, 25)] + [[(0, 0), (1, 1), (3, 3), (2, 2)], [(5, 5)] * 3]
    rows = [(k, [(float(x), float(y)) for x, y in s]) for k, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "k int, pts array<struct<x:double,y:double>>")
    for r in df.select("k", lines.convex_hull(F.col("pts")).alias("ring")).collect():
        pts, ring = set(sets[r["k"]]), [(q["x"], q["y"]) for q in r["ring"]]
        assert ring[0] == ring[-1] == min(pts)
        corners = {a for a in pts if any(all(np.dot((a[0] - b[0], a[1] - b[1]), (np.cos(t), np.sin(t))) > 0 for b in pts if b != a) for t in np.linspace(0.001, 2 * np.pi, 721))}
        assert set(ring) == corners and len(ring) == max(len(corners) + (len(corners) > 1), 1)


def test_clusters_match_pairwise_distance(spark):
    rnd = random.Random(9)
    pts = [(rnd.randrange(0, 400_000), rnd.randrange(0, 400_000)) for _ in range(250)]
    got = {(r["nx"], r["ny"]): r["cluster"] for r in junctions.cluster_nodes(spark.createDataFrame(pts, "nx long, ny long").distinct()).collect()}
    group = {p: p for p in pts}

    def find(p):
        while group[p] != p:
            p = group[p]
        return p

    for a, b in itertools.combinations(pts, 2):
        if (a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2 <= 24_000**2:
            group[find(a)] = find(b)
    for a, b in itertools.combinations(pts, 2):
        assert (got[a] == got[b]) == (find(a) == find(b))


def test_thin_arrows_matches_one_pass(spark):
    rnd = random.Random(4)
    rows = [(i, i, 0, 1, rnd.uniform(0, 120), rnd.uniform(0, 120), rnd.choice([0.0, 1.57, 3.14, -1.57])) for i in range(150)]
    df = spark.createDataFrame(rows, "osm_id long, ord long, pos int, step int, x double, y double, yaw double")
    got = sorted(r["osm_id"] for r in junctions.thin_arrows(df).collect())
    kept = []
    for r in rows:
        def clash(k):
            d = abs(r[6] - k[6]) % (2 * np.pi)
            turn, gap = min(d, 2 * np.pi - d), np.hypot(r[4] - k[4], r[5] - k[5])
            return (turn < 0.35 and gap < 14) or (0.55 < turn < np.pi - 0.55 and gap < 4.2)
        if not any(clash(k) for k in kept):
            kept.append(r)
    assert got == [r[0] for r in kept]


def test_water_is_cut_by_a_slanted_building(spark):
    water = overlay.water_areas(make_ways(spark, [(1, {"natural": "water"}, box(0, 0, 10, 10)), (2, {"waterway": "river"}, [(100, 0), (150, 0)])]))
    cutter = make_ways(spark, [(9, {"building": "yes"}, [(0, 0), (10, 0), (0, 10), (0, 0)])])
    cut = overlay.cut_by(water, overlay.closed_areas(cutter))
    from urbanweave.functions import kernel

    area = {r["osm_id"]: r["a"] for r in cut.select("osm_id", kernel.parts_area(F.col("parts")).alias("a")).collect()}
    assert area[1] == pytest.approx(50.0)
    assert area[2] == pytest.approx(50 * 8 + 32 * np.sin(np.pi / 32) * 16)


def test_widening_grows_a_straight_road(spark):
    n = 40
    px = raster.all_pixels(spark, n, n).withColumn("free", (F.col("col") >= 16) & (F.col("col") < 23))
    wide = raster.widen_corridors(px, n, 2.0).where("free").groupBy("row").count()
    assert {r["count"] for r in wide.collect()} == {15}


def test_distance_carries_the_nearest_site(spark):
    rnd = random.Random(2)
    sites = {(rnd.randrange(20), rnd.randrange(30)): float(i) for i in range(15)}
    px = raster.all_pixels(spark, 20, 30)
    table = spark.createDataFrame([(r, c, v) for (r, c), v in sites.items()], "row long, col long, s double")
    got = raster.nearest_sites(px.join(table, ["row", "col"], "left"), F.col("s").isNotNull(), 30, carry="s").collect()
    for r in got:
        d = {v: (r["row"] - y) ** 2 + (r["col"] - x) ** 2 for (y, x), v in sites.items()}
        assert r["d2"] == min(d.values()) and d[r["carried"]] == r["d2"]


def test_free_wins_where_boxes_overlap(spark):
    grid = raster.Grid.over(-50, -50, 50, 50, 1.0)
    shape = lambda *b: spark.range(1).select(F.array(lines.box_ring(*[F.lit(float(v)) for v in b])).alias("parts"))
    px = {(r["row"], r["col"]): r["v"] for r in raster.paint_occupancy(shape(-10, -10, 10, 10), shape(-40, -2, 40, 2), grid).collect()}
    assert px[(50, 50)] == 254 and px[(42, 50)] == 0 and (10, 10) not in px


XML = """<?xml version='1.0'?><osm version="0.6">
<node id="1" lon="121.5" lat="25.0"/><node id="2" lon="121.501" lat="25.0"/><node id="3" lon="121.501" lat="25.001"/>
<node id="4" lon="121.5" lat="25.001"><tag k="natural" v="tree"/></node>
<way id="10"><nd ref="1"/><nd ref="2"/><nd ref="3"/><nd ref="4"/><nd ref="1"/><tag k="building" v="yes"/></way>
<way id="11"><nd ref="1"/><nd ref="99"/><nd ref="3"/><tag k="highway" v="primary"/><tag k="name" v="測試"/></way>
<way id="12"><nd ref="1"/><nd ref="2"/></way></osm>"""


def varint(n):
    out = b""
    while True:
        out += bytes([n & 127 | (128 if n > 127 else 0)])
        n >>= 7
        if not n:
            return out


def field(no, value):
    return varint(no << 3) + varint(value) if isinstance(value, int) else varint(no << 3 | 2) + varint(len(value)) + value


def zigzag(n):
    return varint((n << 1) ^ (n >> 63))


def small_pbf():
    words = ["", "natural", "tree", "building", "yes", "highway", "primary", "name", "測試"]
    table = field(1, b"".join(field(1, w.encode()) for w in words))
    delta = lambda v: b"".join(zigzag(b - a) for a, b in zip([0, *v], v))
    lon = [1215000000, 1215010000, 1215010000, 1215000000]
    lat = [250000000, 250000000, 250010000, 250010000]
    dense = field(2, field(1, delta([1, 2, 3, 4])) + field(8, delta(lat)) + field(9, delta(lon)) + field(10, bytes([0, 0, 0, 1, 2, 0])))
    way = lambda i, refs, k, v: field(3, field(1, i) + field(2, bytes(k)) + field(3, bytes(v)) + field(8, delta(refs)))
    group = way(10, [1, 2, 3, 4, 1], [3], [4]) + way(11, [1, 99, 3], [5, 7], [6, 8]) + way(12, [1, 2], [], [])
    out = b""
    for kind, data in (("OSMHeader", b""), ("OSMData", table + field(2, dense)), ("OSMData", table + field(2, group))):
        blob = field(2, len(data)) + field(3, zlib.compress(data))
        head = field(1, kind.encode()) + field(3, len(blob))
        out += struct.pack(">I", len(head)) + head + blob
    return out


@pytest.mark.parametrize("kind", ["osm", "osm.pbf"])
def test_map_file(spark, tmp_path, kind):
    path = tmp_path / f"tiny.{kind}"
    path.write_bytes(small_pbf() if kind.endswith("pbf") else XML.encode())
    ways, nodes, bounds = osm_read.read_osm(spark, str(path))
    by_id = {r["osm_id"]: r for r in ways.collect()}
    assert set(by_id) == {10, 11} and by_id[10]["closed"] and len(by_id[11]["coords"]) == 2
    assert by_id[11]["tags"] == {"highway": "primary", "name": "測試"}
    assert [(r["osm_id"], r["tags"]) for r in nodes.collect()] == [(4, {"natural": "tree"})]
    row = bounds.first()
    assert (row["west"], row["north"], row["origin"]["epsg"]) == (pytest.approx(121.5), pytest.approx(25.001), 32651)
    assert by_id[10]["coords"][0]["x"] == pytest.approx(-51.08, abs=0.01)


def test_grey_map_round_trip(spark, tmp_path):
    path = str(tmp_path / "map.pgm")
    grid = np.random.default_rng(1).choice([0, 205, 254], size=(300, 41)).astype(np.uint8)
    with open(path, "wb") as f:
        f.write(b"P5\n# a note\n41 300\n255\n" + grid.tobytes())
    px = pgm.read_pgm(spark, path, background=205)
    assert px.count() == int((grid != 205).sum())
    out = str(tmp_path / "out.pgm")
    pgm.write_pgm(px.select("row", "col", "v"), out, 300, 41, 205)
    assert np.array_equal(pgm.decode(open(out, "rb").read(), out), grid)
    with pytest.raises(ValueError):
        pgm.decode(b"P5\n2 2\n65535\n" + bytes(8), "deep")


def test_shards_are_pruned_by_folder(spark, tmp_path):
    rows = spark.range(500).select(
        F.col("id").alias("osm_id"), F.lit("way").alias("osm_type"), F.format_string("s%d", F.col("id") % 3).alias("catalog_shard")
    )
    catalog.write_shards(rows, str(tmp_path / "shards"))
    back = catalog.read_shards(spark, str(tmp_path / "shards"), "osm_id long, osm_type string, catalog_shard string")
    assert back.where("catalog_shard = 's1'").count() == 167


def test_city_plan_builds_every_layer(spark):
    p = {"highway": "primary", "name": "復興路"}
    ways = make_ways(spark, [
        (1, p, [(-150, 0), (0, 0), (150, 0)]), (2, p, [(0, 0), (0, 150)]), (3, {"highway": "residential"}, [(60, 0), (60, -90)]),
        (4, {"building": "yes", "building:levels": "5"}, box(20, 20, 40, 40)), (5, {"building": "yes"}, box(-5, -3, 5, 3)),
        (6, {"natural": "water"}, box(15, 15, 50, 50)), (7, {"landuse": "grass"}, box(-100, 40, -60, 90)),
    ])
    nodes = spark.createDataFrame([(1, 1, {"natural": "tree"}, 5.0, 80.0)], "osm_id long, ord long, tags map<string,string>, x double, y double")
    layers = city.build(ways, nodes)
    count = {r["layer"]: r["n"] for r in city.statistics(layers).collect()}
    assert count["buildings"] == 1 and count["water"] == 1 and count["vegetation"] == 1 and count["trees"] == 1
    assert count["roads"] == 3 and count["junctions"] == 1 and count["zebra"] == 5 and count["lamps"] > 4 and count["markings"] > 20
    grid = raster.Grid.over(-160, -100, 160, 160, 2.0)
    codes = {r["v"]: r["n"] for r in raster.occupancy_histogram(city.navigation(ways, grid), grid, 0).collect()}
    assert codes[254] > 500 and sum(codes.values()) == grid.nx * grid.ny


def test_markings_stay_on_their_pavement(spark):
    from urbanweave.functions import kernel
    from urbanweave.operators import markings

    ways = make_ways(spark, [(1, {"highway": "motorway"}, [(0, 0), (200, 0)]), (2, {"highway": "primary"}, [(100, -80), (100, 80)])])
    cut = roads.cut_by_rank(roads.pavement(ways))
    paint = markings.road_markings(cut, roads.node_degree(ways)).where("osm_id = 2")
    low = paint.select(F.explode(F.flatten("parts")).alias("p")).select(F.min(F.abs("p.y")).alias("m")).first()["m"]
    assert low == pytest.approx(11.0 - 0.25, abs=1e-6)
    assert paint.where(kernel.parts_area(F.col("parts")) <= 0).count() == 0


def test_utm_target_samples_every_source_pixel(spark):
    west, north, step, n = 121.5, 25.06, 0.0001, 60
    left, top, nrows, ncols = raster.utm_target(spark, west, north - n * step, west + n * step, north, 32651, 10.0)
    source = spark.range(n * n).select(F.floor(F.col("id") / n).alias("row"), (F.col("id") % n).alias("col"), F.lit(1.0).alias("z"))
    target = raster.all_pixels(spark, nrows, ncols)
    place = frame.utm_to_lonlat(left + (F.col("col") + 0.5) * 10.0, F.lit(top) - (F.col("row") + 0.5) * 10.0, 32651)
    at = target.select(place.alias("p")).select(((F.col("p.x") - west) / step - 0.5).alias("fx"), ((F.lit(north) - F.col("p.y")) / step - 0.5).alias("fy"))
    inside = at.where(f"fx > -1 and fx < {n} and fy > -1 and fy < {n}")
    near = inside.select(F.floor("fy").alias("y"), F.floor("fx").alias("x"))
    read = near.selectExpr("explode(array(0, 1)) as j", "y", "x").selectExpr("y + j as row", "explode(array(x, x + 1)) as col").distinct()
    assert source.join(read, ["row", "col"], "left_anti").count() == 0
    out = raster.reproject(source, west, north, step, n, n, 32651, left, top, 10.0, 10.0, nrows, ncols)
    sides = out.agg(F.min("row").alias("a"), F.max("row").alias("b"), F.min("col").alias("c"), F.max("col").alias("d")).first()
    assert sides["a"] <= 1 and sides["b"] >= nrows - 2 and sides["c"] <= 1 and sides["d"] >= ncols - 2
