"""Steps that must not repeat Python calls, go through the driver or shuffle pixels."""

import contextlib
import io
import re
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import zstandard
from conftest import make_ways
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import kernel, lines
from urbanweave.llm import line_dedup, quality_model
from urbanweave.llm.shared_arrays import unpacked_keys
from urbanweave.operators import buildings, markings, mesh, raster, ribbons, roads
from urbanweave.plans import fixtures


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]


def items_of(spark, rects):
    ways = make_ways(spark, [(i, {"building": "yes"}, box(*r)) for i, r in enumerate(rects)])
    items = buildings.footprints(ways).withColumn("area", lines.ring_area(F.col("ring")))
    return items.withColumn("height_m", F.col("osm_id") + 3.0)


RECTS = [(0, 0, 10, 10), (5, 5, 15, 15), (0, 0, 10, 10), (150, 0, 160, 10), (0, 0, 10, 9)]


def test_python_runs_once_per_row(spark):
    # the rule's filter used to copy the Python call
    assert plan_of(items_of(spark, RECTS)).count("ArrowEvalPython") == 1


def test_mixed_rings_keep_their_parts(spark):
    bow = [(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]
    ways = make_ways(spark, [(1, {"building": "yes"}, box(0, 0, 4, 5)), (2, {"building": "yes"}, bow)])
    got = buildings.footprints(ways).select("osm_id", lines.ring_area(F.col("ring")).alias("a")).collect()
    assert sorted((r["osm_id"], round(r["a"], 6)) for r in got) == [(1, 20.0), (2, 25.0), (2, 25.0)]


def test_wall_descriptions_are_not_broadcast(spark):
    walls = mesh.wall_quads(items_of(spark, RECTS))
    assert "Broadcast" not in plan_of(walls) and walls.count() == 4 * len(RECTS)


def test_cell_masses_gather_no_group_in_python(spark):
    masses = mesh.union_footprints(items_of(spark, RECTS), 100.0)
    assert "FlatMapGroups" not in plan_of(masses)
    got = {round(r["a"], 6): r["height_m"] for r in masses.select(kernel.parts_area(F.col("parts")).alias("a"), "height_m").collect()}
    assert got == {175.0: 7.0, 100.0: 6.0}


def test_cover_pairs_of_boxes_and_other_rings(spark):
    ways = make_ways(spark, [(0, {"building": "yes"}, box(0, 0, 10, 10)), (1, {"building": "yes"}, box(0, 0, 10, 9)),
                             (2, {"building": "yes"}, [(0, 0), (10, 0), (10, 9.5), (5, 10), (0, 9.5), (0, 0)])])
    shapes = ways.select(F.col("osm_id").alias("shape"), F.col("coords").alias("ring"), lines.ring_area(F.col("coords")).alias("area"))
    pairs = buildings.cover_pairs(shapes)
    plan = plan_of(pairs)
    assert "Union" not in plan and "BroadcastHashJoin" not in plan  # one join, and none through the driver
    assert sorted(tuple(r) for r in pairs.collect()) == [(1, 0, True), (1, 2, True), (2, 0, True)]


def test_pixels_are_not_shuffled(spark):
    grid = raster.Grid.over(0.0, 0.0, 40.0, 30.0, 1.0)
    schema = "osm_id long, x0 double, y0 double, x1 double, y1 double"
    parts = lambda rows: spark.createDataFrame(rows, schema).select(
        "osm_id", F.array(lines.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))).alias("parts"))
    occ = [(1, 2.0, 2.0, 9.0, 9.0), (2, 5.0, 4.0, 12.0, 20.0), (3, 2.0, 2.0, 9.0, 9.0), (4, -5.0, 25.0, 50.0, 27.0)]
    fre = [(5, 7.0, 0.0, 8.0, 30.0), (6, 11.0, 4.0, 15.0, 5.0), (7, 7.0, 0.0, 8.0, 30.0)]
    px = raster.paint_occupancy(parts(occ), parts(fre), grid)
    assert all("col" not in keys for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan_of(px)))
    inside = lambda rows, x, y: any(r[1] < x < r[3] and r[2] < y < r[4] for r in rows)
    want = {}
    for row in range(30):
        for col in range(40):
            x, y = col + 0.5, 30 - row - 0.5
            if inside(fre, x, y) or inside(occ, x, y):
                want[row, col] = K.FREE if inside(fre, x, y) else K.OCCUPIED
    got = px.collect()
    assert len(got) == len(want) and {(r["row"], r["col"]): r["v"] for r in got} == want
    counts = {r["v"]: r["n"] for r in raster.occupancy_histogram(px, grid).collect()}
    assert counts[K.UNKNOWN] == 1200 - len(want)
    none = raster.occupancy_histogram(px.where("false"), grid).collect()
    assert [(r["v"], r["n"]) for r in none] == [(K.UNKNOWN, 1200)]


def test_dashes_in_one_pass(spark):
    rows = [("a_dash", [(0.0, 0.0), (50.0, 0.0)]), ("solid", [(0.0, 0.0), (50.0, 0.0)]), ("b_dash", [(0.0, 0.0), (0.01, 0.0)])]
    stripes = spark.createDataFrame(rows, "style string, line array<struct<x:double,y:double>>")
    out = markings.dash(stripes)
    assert "Union" not in plan_of(out)
    got = sorted((r["style"], r["seq"], r["line"][0]["x"], r["line"][-1]["x"]) for r in out.collect())
    period, n = K.DASH_ON_M + K.DASH_GAP_M, 0
    while n * period < 50.0 and min(50.0, n * period + K.DASH_ON_M) - n * period >= K.DASH_MIN_M:
        n += 1
    assert [g[:2] for g in got] == [("a_dash", k) for k in range(n)] + [("solid", 0)] and got[-1][2:] == (0.0, 50.0)


def test_flat_buffers_equal_objects():
    rows = [[], [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)], [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 6.0)]], [[(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]]]
    made = kernel.packed(rows)
    assert made.to_pylist() == [kernel.points_of(r) for r in rows]
    for part in (made, made.slice(1), pa.concat_arrays([made, made])):
        assert list(kernel.each_region(part)) == [kernel.rings_of(r) for r in part.to_pylist()]


def test_nearest_columns_are_those_of_all_pairs_with_ties_to_the_nearest_then_left():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 7, 16, 33):
        for share in (0.0, 0.3, 0.9, 1.0):
            along = rng.integers(0, 6, (8, n)).astype(float) ** 2
            along[rng.random((8, n)) < share] = np.inf
            sums, source = raster.nearest_columns(along)
            for row in range(8):
                for i in range(n):
                    best = min((along[row, j] + (i - j) ** 2, abs(i - j), j) for j in range(n))
                    assert (sums[row, i], source[row, i]) == (best[0], best[2] if np.isfinite(best[0]) else i)


def test_a_wide_row_with_a_single_site_is_not_walked_column_by_column():
    along = np.full((2, 60_000), np.inf)
    along[0, 0] = 9.0
    start = time.process_time()
    sums, source = raster.nearest_columns(along)
    assert time.process_time() - start < 10
    assert (sums[0] == 9.0 + np.arange(60_000.0) ** 2).all() and np.isinf(sums[1]).all() and (source[0] == 0).all()


def test_a_kernel_runs_on_filled_rows_only():
    square = [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]]
    parts = kernel.packed([[], square, [], [], square])
    seen = []

    def copy(some):
        seen.append(len(some))
        return some

    assert kernel.on_filled(copy, parts).to_pylist() == parts.to_pylist() and seen == [2]
    assert kernel.on_filled(copy, parts.slice(2, 2)).to_pylist() == [[], []] and seen == [2]


def test_a_blend_is_the_mean_of_the_stations_around(spark):
    """Ways of different jumps have different reaches; each equals the plain mean over its stations."""
    rows = [(o, i, 0, 50.0 * i, 0.0, 6.0 + i % 2 * o) for o in (0, 1, 5, 6, 8, 12) for i in range(4)]
    got = ribbons.blended(spark.createDataFrame(rows, "ord long, i int, k int, x double, y double, w double")).collect()
    assert len(got) == 4 + 5 * (1 + 3 * 25)
    for o in (1, 5, 6, 8, 12):
        mine = sorted((r["i"], r["m"], r["w"]) for r in got if r["ord"] == o)
        plain = [6.0 + i % 2 * o for i, _, _ in mine]
        reach = int(min(20.0, max(10.0, 2.0 * o)) // 2)
        for k, (_, _, w) in enumerate(mine):
            near = plain[max(0, k - reach) : k + reach + 1]
            assert abs(w - sum(near) / len(near)) < 1e-9


def test_pavement_is_gathered_without_dealing_outlines_out_again(spark):
    """Behind the windows of a way nothing is shuffled but the other columns of the ways, all before the Python call."""
    line = [(0, 0), (10, 0), (10.5, 3), (3, 3)]
    ways = make_ways(spark, [(1, {"highway": "primary"}, line)]).withColumn("widths", F.array_repeat(F.lit(8.0), 4))
    rows = [(1, i, 0, 1, float(x), float(y), 8.0) for i, (x, y) in enumerate(line)]
    vertices = spark.createDataFrame(rows, "ord long, i int, k int, m int, x double, y double, w double")
    assert ribbons.raw_strips(vertices).where("fold").count() > 0
    paved = ribbons.paved(ways, vertices)
    plan = plan_of(paved)
    assert "Exchange" not in plan[: plan.index("ArrowEvalPython")]
    apart = ribbons.strips(vertices).orderBy("i", "k", "m", "part_no").collect()
    assert paved.first()["parts"] == [r["part"] for r in apart]
    assert [(p["x"], p["y"]) for p in paved.first()["coords"]] == line
    # vertices that come twice keep the order of the windows, so each strip is cut by the one before it there
    twice = vertices.unionByName(vertices)
    pieces = ribbons.strips(twice).collect()
    area = lambda ring: abs(sum(p["x"] * q["y"] - q["x"] * p["y"] for p, q in zip(ring, ring[1:]))) / 2
    gathered = ribbons.paved(ways, twice).first()["parts"]
    assert abs(sum(area(r["part"]) for r in pieces) - sum(map(area, gathered))) < 1e-9


def test_line_keys_lower_ascii_letters_only(spark):
    """The quick rule for lines of ASCII gives what the rule by characters gives; other letters keep their case."""
    lines_in = ["  Ab C\x0b", "\u00c4B \u212a\tZ", "", " \u00a0X ", "\x00Q\x7f", None]
    df = spark.createDataFrame([(t,) for t in lines_in], "t string")
    got = [r[0] for r in df.select(line_dedup.line_key(F.col("t"))).collect()]
    assert got == ["ab c", "\u00c4b \u212a\tz", "", "\u00a0x", "\x00q\x7f", None]


def test_lines_are_hashed_outside_of_lambdas(spark):
    """A lambda is interpreted: a key was made four times and compared as a struct, in the square of the lines of a text."""
    docs = spark.createDataFrame([(i, "Same\nline\nown %d" % i) for i in range(12)], "doc_id long, text string")
    rows = line_dedup.dedup_lines(docs)
    assert not re.search(r"lambdafunction\((named_)?struct\(.*xxhash64", str(rows._jdf.queryExecution().analyzed().toString()))
    assert {(r["n_lines"], r["n_dropped"], r["kept"]) for r in rows.collect()} == {(3, 2, f"own {i}") for i in range(12)}


def test_cut_lineage_gives_its_shuffle_files_back(spark):
    import glob
    import time

    from pyspark.sql import functions as F

    from urbanweave.session import FREE_SHUFFLES, cut_lineage

    folders = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before, setting = files(), spark.conf.get(FREE_SHUFFLES, None)
    kept = spark.range(10_000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    cut = cut_lineage(kept)
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before
    assert spark.conf.get(FREE_SHUFFLES, None) == setting
    assert cut.count() == 7 and kept.count() == 7 and kept.count() == 7


def test_junction_candidates_write_no_tags(spark, monkeypatch):
    from urbanweave.operators import junctions, roads

    written = []
    cut = junctions.cut_lineage
    monkeypatch.setattr(junctions, "cut_lineage", lambda df: written.append(df.columns) or cut(df))
    ways = make_ways(spark, [
        (1, {"highway": "primary", "name": "a"}, [(0, 0), (100, 0)]),
        (2, {"highway": "secondary", "lanes": "2"}, [(50, -50), (50, 0), (50, 50)]),
        (3, {"highway": "primary"}, [(100, 0), (200, 0)]),
        (4, {"highway": "primary"}, [(100, 0), (100, 90)]),
    ])
    found = junctions.junction_candidates(ways, roads.node_degree(ways)).collect()
    assert {(r["osm_id"], r["nx"], r["pos"]) for r in found} == {(1, 100_000, 1), (3, 100_000, 0), (4, 100_000, 0)}
    assert written and not any("tags" in columns for columns in written)


def test_shard_manifest_sums_the_counts(spark):
    from urbanweave.operators import osm

    rows = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "catalog_shard string")
    out = osm.shard_manifest(rows)
    assert [(r[0], r[1], r[2]) for r in out.collect()] == [(None, 1, 4), ("a", 2, 4), ("b", 1, 4)]
    assert "sum(feature_count" in out._jdf.queryExecution().optimizedPlan().toString()


def test_vertex_mean_of_five_adds_in_order(spark):
    rings = [[(0.1, -0.0), (1e16, 2.5), (0.3, 0.7), (-1e16, 0.9), (0.1, -0.0)], [(0.1, 0.2), (0.3, 0.5)]]
    rows = spark.createDataFrame([(i, r) for i, r in enumerate(rings)], "i int, c array<struct<x:double,y:double>>")
    got = rows.orderBy("i").select(lines.vertex_mean(F.col("c")).alias("m")).collect()
    for ring, row in zip(rings, got, strict=True):
        sums = [0.0, 0.0]
        for p in ring:
            sums = [s + v for s, v in zip(sums, p, strict=True)]
        assert (row["m"]["x"], row["m"]["y"]) == (sums[0] / len(ring), sums[1] / len(ring))


def order_tables(spark, folder):
    """Orders of one to four items; key 6 comes twice, key 7 without items, and one customer is null."""
    orders = [(1, 5, "F", "1-URGENT"), (3, 8, "O", "2-HIGH"), (6, 2, "F", "3-MEDIUM"), (6, 9, "O", "5-LOW"), (7, 1, "F", "2-HIGH"), (9, None, "F", "2-HIGH")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string").write.parquet(f"{folder}/orders.parquet")
    items = [(k, i) for k, n in ((1, 1), (3, 4), (6, 1), (9, 3)) for i in range(n)]
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int").write.parquet(f"{folder}/lineitem.parquet")


def test_ways_of_repeated_orders_keep_all_vertices(spark, tmp_path):
    order_tables(spark, tmp_path)
    ways = fixtures.ways(spark, str(tmp_path))
    assert "posexplode" not in plan_of(ways) and "Generate" not in plan_of(ways)  # vertices are not taken apart and shuffled
    vertices = fixtures.way_nodes(spark, str(tmp_path)).collect()
    want = {}
    for r in sorted(vertices, key=lambda r: (r["way_id"], r["seq"], r["x"] or 0.0, r["y"] or 0.0)):
        want.setdefault(r["way_id"], []).append((r["x"], r["y"]))
    rows = ways.collect()
    assert sorted((r["osm_id"], r["tags"]["highway"]) for r in rows) == [(3, "primary"), (6, "footway"), (6, "secondary"), (9, "primary")]
    for r in rows:
        assert [(p["x"], p["y"]) for p in r["coords"]] == want[r["osm_id"]]


def test_valid_rings_do_not_pass_python(spark):
    bow = [(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]
    kite = [(0, 0), (4, 1), (5, 5), (1, 4), (0, 0)]
    ways = make_ways(spark, [(1, {"building": "yes"}, kite), (2, {"building": "yes"}, bow)])
    rings = buildings.footprints(ways)
    assert "Union" in plan_of(rings)  # the rows without a crossing take a branch of their own
    got = sorted((r["osm_id"], r["part_no"], round(r["others"], 6)) for r in rings.collect())
    assert got == [(1, 0, 0.0), (2, 0, 25.0), (2, 1, 25.0)]


def test_sub_line_makes_its_segments_once(spark):
    c = F.col("coords")
    ways = make_ways(spark, [(1, {}, [(0, 0), (10, 0), (10, 10), (20, 10)]), (2, {}, [(0, 0), (0, 0), (3, 4)])])
    cut = ways.select("osm_id", lines.sub_line(c, F.lit(4.0), F.lit(25.0)).alias("a"), lines.sub_line(c, F.lit(-1.0), F.lit(10.0)).alias("b"))
    got = {r["osm_id"]: ([tuple(p) for p in r["a"]], [tuple(p) for p in r["b"]]) for r in cut.collect()}
    assert got[1] == ([(4.0, 0.0), (10.0, 0.0), (10.0, 10.0), (15.0, 10.0)], [(0.0, 0.0), (0.0, 0.0), (10.0, 0.0)])
    assert got[2] == ([(3 * 0.8, 3.2), (3.0, 4.0), (3.0, 4.0)], [(0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (3.0, 4.0), (3.0, 4.0)])
    assert plan_of(ways.select(lines.sub_line(c, F.lit(4.0), F.lit(25.0)).alias("s"))).count("zip_with") == 1


def test_junction_windows_are_joined_once(spark):
    cross = [(1, {"highway": "primary"}, [(-50, 0), (0, 0), (50, 0)]), (2, {"highway": "primary"}, [(0, -50), (0, 0), (0, 50)])]
    ways = make_ways(spark, cross)
    pieces = markings.split_at_junctions(ways, roads.node_degree(ways))
    assert "cx" not in plan_of(pieces)  # the cells of the spatial join are behind a lineage cut
    assert sorted(r["osm_id"] for r in pieces.collect()) == [1, 1, 2, 2]


def test_context_sums_are_copied_by_shard():
    text = " ".join(f"w{n}" for n in range(300_000))
    batch = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])
    hashes, sums = quality_model.block_sums(iter([text.encode()]))
    tracemalloc.start()
    rows = next(quality_model.count_contexts(iter([batch]), 32)).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(len(unpacked_keys(zstandard.ZstdDecompressor().decompress(r["keys"]))) for r in rows) == len(hashes)
    assert peak < 3.3 * sums.nbytes


def test_distance_runs_along_a_column_from_both_ends(spark):
    """A frame up to the end of a column is summed up anew for every row: the square of the column's length (F6, F7, F9, F13)."""
    px = raster.all_pixels(spark, 40, 3).withColumn("s", (F.col("row") * 3 + F.col("col")) % 37 == 5)
    d = raster.nearest_sites(px.unionByName(px.where("col = 1")), F.col("s"), 3)
    assert "unboundedfollowing" not in plan_of(d).lower()
    rows = d.collect()
    sites = [(r["row"], r["col"]) for r in px.where("s").collect()]
    assert len(rows) == 160 and len(sites) > 2
    for r in rows:
        assert r["d2"] == min((r["row"] - y) ** 2 + (r["col"] - x) ** 2 for y, x in sites)


def test_half_width_of_a_buffer_is_judged_once_a_line(spark):
    """Each corner of each disc read the tags for the width again (F5, F4)."""
    way = make_ways(spark, [(1, {"highway": "primary", "width": "8"}, [(0, 0), (50, 0), (50, 50)])])
    parts = way.select(lines.buffer_parts(F.col("coords"), F.sqrt(F.col("tags")["width"].cast("double") * 2)).alias("parts"))
    assert plan_of(parts.withColumn("n", F.size("parts"))).lower().count("sqrt(") <= 2 + 1  # the width, and the length of a segment
    rings = parts.first()["parts"]
    assert [len(r) for r in rings] == [5, 5, 65, 65, 65]
    for ring, (x, y) in zip(rings[2:], [(0, 0), (50, 0), (50, 50)]):
        assert all(abs(np.hypot(p["x"] - x, p["y"] - y) - 4) < 1e-9 for p in ring)


def test_parts_are_made_after_the_filter_and_once(spark):
    """An explode puts its rule twice into a filter, where it may run on rows that other filters drop (F5)."""
    rows = spark.range(10).where("id % 5 = 1").withColumn("parts", F.transform(F.sequence(F.lit(0), F.col("id")), lambda i: F.sqrt(i + F.col("id"))))
    count = lambda df: plan_of(df.select(F.explode("parts").alias("p"))).lower().count("sqrt(")
    assert count(lines.finished(rows, "parts")) == 1 < count(rows)
    assert lines.finished(rows, "parts").collect() == rows.collect()


def test_painting_shuffles_parts_not_spans(spark):
    """Every pixel row of every part went through the shuffle with both its ends (F11, F12)."""
    grid = raster.Grid.over(0, 0, 600, 900, 3.0)  # 300 rows: five bands
    occupied = make_ways(spark, [(1, {}, box(10, 10, 400, 890)), (2, {}, [(0, 0), (500, 100), (250, 850), (0, 0)])]).select(F.array("coords").alias("parts"))
    free = make_ways(spark, [(3, {}, box(100, 300, 130, 880)), (4, {}, [(300, 20), (420, 500), (280, 480), (300, 20)])]).select(F.array("coords").alias("parts"))
    for touched in (False, True):
        runs = raster.painted_runs(occupied, free, grid, touched)
        plan = plan_of(runs)
        assert "hashpartitioning(band" in plan and "hashpartitioning(row" not in plan
        want = {(r["row"], r["col"]): K.OCCUPIED for r in raster.rasterize(occupied, grid).collect()}
        want |= {(r["row"], r["col"]): K.FREE for r in raster.rasterize(free, grid, touched).collect()}
        got = {(r["row"], c): r["v"] for r in runs.collect() for c in range(r["c0"], r["c1"] + 1)}
        assert got == want and len(got) == runs.select(F.sum(F.col("c1") - F.col("c0") + 1)).first()[0]


def test_cutting_leaves_far_rings_and_edges_alone(monkeypatch):
    """A ring was clipped by all edges of every cutter, near or far, and cut by them once more (F4)."""
    disc = [(4 * np.cos(a), 4 * np.sin(a)) for a in np.arange(64) * np.pi / 32]
    calls = []
    split = kernel.split_by_line
    monkeypatch.setattr(kernel, "split_by_line", lambda *a: calls.append(a) or split(*a))
    assert kernel.subtract(disc, [(50, -4), (60, -4), (60, 4), (50, 4)]) == [disc] and not calls
    half = kernel.subtract(disc, [(0, -4), (50, -4), (50, 4), (0, 4)])
    assert len(calls) == 1 and abs(kernel.region_area(half) - kernel.region_area([disc]) / 2) < 1e-9
    assert kernel.subtract(disc, [(3, -3), (3, 3), (-3, 3)]) and kernel.subtract(disc, [(-9, -9), (9, -9), (9, 9), (-9, 9)]) == []


def test_stripes_are_made_once(spark):
    """The stripes of a piece were made for a filter in front of the explode, and the dashes again for each reader (F2)."""
    ways = make_ways(spark, [(1, {"highway": "primary", "lanes": "4"}, [(0, 0), (50, 0)]), (2, {"highway": "secondary"}, [(0, 9), (30, 9)])])
    pieces = ways.withColumn("piece_no", F.lit(0)).withColumn("piece", F.col("coords")).withColumn("piece_widths", F.array(F.lit(8.0), F.lit(8.0)))
    rows = markings.dash(markings.marking_lines(pieces))
    filters = [line for line in plan_of(rows).splitlines() if " Filter " in line]
    assert not any("lambda" in line for line in filters) and rows.count() > 2
