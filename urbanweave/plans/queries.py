"""The registered queries: one per operator or small family, over the derived map of a test-data folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import frame, kernel, lines, tags
from urbanweave.operators import assets, buildings, extent, junctions, markings, mesh, osm, overlay, placement, raster, ribbons, roads
from urbanweave.plans import fixtures as fx
from urbanweave.session import stored

QUERIES: dict = {}
CELL_SHARD_M = 200.0


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rnd(c: Column | str, digits: int = 6) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, digits) + 0.0


def side(spark: SparkSession, sf: str) -> float:
    return 50.0 * fx.lattice_width(spark, sf)


def way_features(spark: SparkSession, sf: str) -> DataFrame:
    areas = fx.boxes_to_ways(fx.area_boxes(spark, sf))
    ways = fx.ways(spark, sf).unionByName(fx.buildings(spark, sf)).unionByName(areas)
    return osm.features(ways, fx.trees(spark, sf), 0.0, side(spark, sf))


def road_table(spark: SparkSession, sf: str) -> DataFrame:
    """The ways as a written table, for operators that read them many times."""
    return stored(fx.ways(spark, sf))


# ---- sources and catalogue


@query
def shard_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Features per catalogue shard and category."""
    rows = way_features(spark, sf).groupBy("catalog_shard", "category").agg(F.count("*").alias("n_features"))
    return rows.orderBy("catalog_shard", "category")


@query
def shard_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return osm.shard_manifest(way_features(spark, sf))


@query
def feature_centroids(spark: SparkSession, sf: str) -> DataFrame:
    rows = way_features(spark, sf)
    return rows.select("osm_id", "osm_type", "category", rnd("x", 4).alias("x"), rnd("y", 4).alias("y"), "catalog_shard")


@query
def way_assembly(spark: SparkSession, sf: str) -> DataFrame:
    """Way references joined to nodes and collected in order."""
    vertices = fx.way_nodes(spark, sf)
    key = ((F.col("x") + 100000) * 10000000 + (F.col("y") + 100000)).cast("long")
    refs = vertices.select("way_id", F.col("seq").alias("pos"), key.alias("ref"))
    nodes = vertices.select(key.alias("node_id"), "x", "y").distinct()
    ways = osm.assemble_ways(refs, nodes, fx.way_tags(spark, sf))
    first, last = lines.first(F.col("coords")), lines.last(F.col("coords"))
    return ways.select(
        "osm_id", F.size("coords").cast("long").alias("n_vertices"), rnd(lines.length(F.col("coords"))).alias("len"),
        first["x"].alias("x_first"), first["y"].alias("y_first"), last["x"].alias("x_last"), last["y"].alias("y_last"),
        "closed",
    )


@query
def tagged_node_counts(spark: SparkSession, sf: str) -> DataFrame:
    tagged = osm.tagged_nodes(fx.trees(spark, sf))
    return tagged.groupBy(F.size("tags").alias("n_tags")).agg(
        F.count("*").alias("n"), F.sum(F.col("x").cast("long")).alias("sum_x"), F.sum(F.col("y").cast("long")).alias("sum_y")
    )


@query
def lonlat_bounds(spark: SparkSession, sf: str) -> DataFrame:
    box = osm.lonlat_bounds(fx.lonlat_points(spark, sf))
    return box.select(
        *[rnd(c, 6).alias(c) for c in ("west", "south", "east", "north")],
        rnd("origin.lon").alias("origin_lon"), rnd("origin.lat").alias("origin_lat"), F.col("origin.epsg").alias("epsg"),
    )


@query
def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    nodes = fx.trees(spark, sf)
    ways = fx.ways(spark, sf)
    areas = fx.boxes_to_ways(fx.area_boxes(spark, sf))
    return osm.layer_counts(
        roads=ways.where(tags.highway() != ""),
        motor_roads=ways.where(tags.is_motor()),
        buildings=fx.buildings(spark, sf).where(tags.has_tag("building")),
        water=areas.where(tags.is_water_area()),
        vegetation=areas.where(tags.is_vegetation()),
        trees=placement.tree_instances(nodes),
    )


# ---- tag rules


@query
def road_tag_rules(spark: SparkSession, sf: str) -> DataFrame:
    w = tags.road_width()
    kind = tags.marking_kind()
    return fx.ways(spark, sf).select(
        "osm_id", rnd(w, 3).alias("width"), tags.lane_count().cast("long").alias("lanes"),
        rnd(tags.inbound_offset(), 4).alias("inbound_offset"), tags.is_motor().alias("motor"),
        tags.is_major().alias("major"), tags.is_primary_junction().alias("primary_junction"),
        tags.is_roundabout().alias("roundabout"), tags.is_bufferable().alias("bufferable"),
        tags.road_rank().cast("long").alias("road_rank"), tags.grade_key().alias("grade"),
        rnd(tags.road_elevation(), 1).alias("elevation"), kind["center"].alias("center"), kind["lane"].alias("lane"),
        kind["edge"].alias("edge"), tags.road_surface().alias("surface"),
        rnd(tags.road_rgb(tags.road_surface())["r"], 3).alias("red"),
    )


@query
def road_width_scaled(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.ways(spark, sf).select(rnd(tags.road_width(scale=1.6), 4).alias("width"))
    return rows.groupBy("width").agg(F.count("*").alias("n"))


@query
def display_names(spark: SparkSession, sf: str) -> DataFrame:
    name = tags.display_name()
    return fx.ways(spark, sf).select("osm_id", name.alias("name"), tags.sign_label(name).alias("label"))


@query
def building_tag_rules(spark: SparkSession, sf: str) -> DataFrame:
    band = tags.facade_band(tags.building_height())
    return fx.buildings(spark, sf).select(
        "osm_id", tags.building_floors().cast("long").alias("floors"), rnd(tags.building_height(), 2).alias("height_m"),
        band.alias("band"), tags.tile_floors(band).cast("long").alias("tile_floors"),
        rnd(tags.sheet_width(band), 1).alias("sheet_width"), tags.variant_count(band).cast("long").alias("variants"),
        tags.is_shop().alias("shop"), tags.facade_key(band, F.col("osm_id")).alias("facade"),
        tags.roof_key(F.col("osm_id")).alias("roof"), rnd(tags.facade_rgb(band)["b"], 3).alias("blue"),
    )


@query
def area_tag_rules(spark: SparkSession, sf: str) -> DataFrame:
    return fx.area_boxes(spark, sf).select(
        "osm_id", tags.is_water_area().alias("water"), tags.is_waterway().alias("waterway"),
        rnd(tags.waterway_width(), 1).alias("waterway_width"), tags.is_vegetation().alias("vegetation"),
        tags.category().alias("category"),
    )


@query
def same_road_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Ways that follow each other in file order: same name, same chain class."""
    ways = fx.ways(spark, sf).select("osm_id", "tags")
    nxt = ways.select((F.col("osm_id") - 1).alias("osm_id"), F.col("tags").alias("next_tags"))
    return ways.join(nxt, "osm_id").select(
        "osm_id", tags.same_named_road("tags", "next_tags").alias("same_name"),
        tags.same_chain_class("tags", "next_tags").alias("same_class"),
    )


# ---- frame


@query
def utm_forward(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.lonlat_points(spark, sf)
    epsg = tags.col("epsg")
    p = p.withColumn("epsg", frame.utm_epsg(F.col("lon"), F.col("lat")))
    p = p.withColumn("u", frame.lonlat_to_utm(F.col("lon"), F.col("lat"), epsg))
    return p.select("point_id", epsg.cast("long").alias("epsg"), rnd("u.x", 3).alias("east"), rnd("u.y", 3).alias("north"))


@query
def utm_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.lonlat_points(spark, sf).withColumn("epsg", frame.utm_epsg(F.col("lon"), F.col("lat")))
    p = p.withColumn("u", frame.lonlat_to_utm(F.col("lon"), F.col("lat"), F.col("epsg")))
    p = p.withColumn("b", frame.utm_to_lonlat(F.col("u.x"), F.col("u.y"), F.col("epsg")))
    return p.select("point_id", rnd("b.x", 7).alias("lon"), rnd("b.y", 7).alias("lat"))


@query
def local_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Metres from each point's own origin half a degree south-west of it, and the way back."""
    p = fx.lonlat_points(spark, sf)
    origin = frame.make_origin(F.floor(F.col("lon") / 6) * 6 + 3.0, F.col("lat") - 0.5)
    p = p.withColumn("o", origin)
    p = p.withColumn("m", frame.lonlat_to_local(F.col("lon"), F.col("lat"), F.col("o")))
    p = p.withColumn("b", frame.local_to_lonlat(F.col("m.x"), F.col("m.y"), F.col("o")))
    return p.select(
        "point_id", rnd("m.x", 3).alias("x"), rnd("m.y", 3).alias("y"), rnd("b.x", 7).alias("lon"), rnd("b.y", 7).alias("lat")
    )


# ---- line geometry and placement


@query
def way_shape(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("coords")
    mean = lines.vertex_mean(c)
    return fx.ways(spark, sf).select(
        "osm_id", rnd(lines.length(c)).alias("len"), rnd(mean["x"], 4).alias("x"), rnd(mean["y"], 4).alias("y"),
        rnd(lines.start_heading(c), 6).alias("start_heading"), rnd(lines.end_heading(c), 6).alias("end_heading"),
        lines.opposite(lines.start_heading(c), lines.end_heading(c)).alias("straight_ends"),
        rnd(lines.turn_sum(c), 6).alias("turn"), lines.looks_like_ring(c, F.col("closed")).alias("ring"),
    )


@query
def building_shape(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("coords")
    center = lines.ring_centroid(c)
    return fx.buildings(spark, sf).select(
        "osm_id", rnd(lines.ring_area(c), 3).alias("area"), rnd(center["x"], 4).alias("cx"), rnd(center["y"], 4).alias("cy")
    )


@query
def lamps(spark: SparkSession, sf: str) -> DataFrame:
    rows = placement.lamp_instances(fx.ways(spark, sf))
    return rows.select(
        "osm_id", F.col("seq").cast("long").alias("seq"), F.col("side").cast("long").alias("side"),
        rnd("x", 4).alias("x"), rnd("y", 4).alias("y"), rnd("yaw", 6).alias("yaw"),
    )


@query
def signs(spark: SparkSession, sf: str) -> DataFrame:
    rows = placement.sign_placements(fx.ways(spark, sf))
    return rows.select(
        "osm_id", F.col("seq").cast("long").alias("seq"), rnd("x", 4).alias("x"), rnd("y", 4).alias("y"),
        rnd("yaw", 6).alias("yaw"), "name",
    )


@query
def sign_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = placement.sign_names(placement.sign_placements(fx.ways(spark, sf)))
    return rows.select(F.col("rank").cast("long").alias("sign_rank"), "label", "n")


@query
def tree_transforms(spark: SparkSession, sf: str) -> DataFrame:
    rows = placement.with_draw_distance(placement.instance_transforms(placement.tree_instances(fx.trees(spark, sf))), "tree")
    return rows.select("osm_id", "x_cm", "y_cm", "qw", "qz", "start_m", "end_m", "start_cm", "end_cm")


@query
def lamp_transforms(spark: SparkSession, sf: str) -> DataFrame:
    rows = placement.instance_transforms(placement.lamp_instances(fx.ways(spark, sf)))
    return rows.groupBy("osm_id").agg(
        rnd(F.sum("x_cm"), 2).alias("x_cm"), rnd(F.sum("y_cm"), 2).alias("y_cm"), rnd(F.sum("qw"), 5).alias("qw"),
        rnd(F.sum("qz"), 5).alias("qz"),
    )


# ---- buildings and degree


@query
def degree_histogram(spark: SparkSession, sf: str) -> DataFrame:
    degree = roads.node_degree(fx.ways(spark, sf))
    return degree.groupBy("degree").agg(F.count("*").alias("n_nodes"), F.sum("nx").alias("sum_nx"))


@query
def carriageway_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Buildings nearer to a motor road than its half width."""
    rings = buildings.footprints(fx.buildings(spark, sf))
    return buildings.carriageway_hits(rings, buildings.carriageway_segments(fx.ways(spark, sf)))


@query
def footprints_after_roads(spark: SparkSession, sf: str) -> DataFrame:
    segments = buildings.carriageway_segments(fx.ways(spark, sf))
    rows = buildings.footprints_after_roads(fx.buildings(spark, sf), segments)
    return rows.select("osm_id", rnd("area", 3).alias("area"), rnd("height_m", 2).alias("height_m"))


@query
def carriageway_segments(spark: SparkSession, sf: str) -> DataFrame:
    rows = buildings.carriageway_segments(fx.ways(spark, sf))
    c = F.col("coords")
    return rows.select(
        "osm_id", F.col("seg").cast("long").alias("seg"), rnd(lines.length(c), 4).alias("len"), rnd("half", 3).alias("half"),
        rnd(lines.first(c)["x"], 3).alias("x"), rnd(lines.first(c)["y"], 3).alias("y"),
    )


def city_items(spark: SparkSession, sf: str) -> DataFrame:
    """All building rectangles as footprint items, before any test."""
    rings = buildings.footprints(fx.buildings(spark, sf))
    return rings.withColumn("area", lines.ring_area(F.col("ring"))).withColumn("height_m", tags.building_height())


@query
def cover_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of different outlines where one covers at least 85 % of the other, per smaller outline's corner."""
    items = city_items(spark, sf)
    shapes = items.groupBy("ring", "area").agg(F.min("osm_id").alias("shape"))
    return buildings.cover_pairs(shapes).select("i_shape", "j_shape", "larger")


@query
def enclosed_buildings(spark: SparkSession, sf: str) -> DataFrame:
    return buildings.enclosed_ids(city_items(spark, sf))


@query
def lod_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = buildings.lod_groups(city_items(spark, sf))
    return rows.select("cell", "ix", "iy", "n", "x0", "y0", "x1", "y1", rnd("height_m", 2).alias("height_m"))


@query
def facade_cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = buildings.facade_groups(city_items(spark, sf))
    return rows.select("cell", "band", F.col("variant").cast("long").alias("variant"), "n")


# ---- rasters


def px_frame(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    n = fx.pixel_side(spark, sf)
    return fx.pixels(spark, sf).select("row", "col", "v"), n


def px_dense(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    px, n = px_frame(spark, sf)
    return raster.dense(px, n, n, v=K.UNKNOWN), n


def free_mask(spark: SparkSession, sf: str) -> tuple[DataFrame, int]:
    px, n = px_dense(spark, sf)
    return px.select("row", "col", (F.col("v") == K.FREE).alias("free")), n


def box_parts(boxes: DataFrame) -> DataFrame:
    ring = lines.box_ring(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    return boxes.select("osm_id", F.array(ring).alias("parts"))


def nav_grid(spark: SparkSession, sf: str) -> raster.Grid:
    w = side(spark, sf)
    return raster.Grid.over(0.0, 0.0, w, w, 3.0)


def nav_layers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    areas = fx.area_boxes(spark, sf).where(tags.is_water_area())
    occupied = box_parts(fx.building_boxes(spark, sf)).unionByName(box_parts(areas))
    return occupied, roads.motor_strips(fx.ways(spark, sf)).select("osm_id", "parts")


@query
def occupancy_paint(spark: SparkSession, sf: str) -> DataFrame:
    """Occupied buildings and water, free motor roads, by the pixel-centre rule at 3 m."""
    occupied, free = nav_layers(spark, sf)
    return raster.paint_occupancy(occupied, free, nav_grid(spark, sf))


@query
def occupancy_touched(spark: SparkSession, sf: str) -> DataFrame:
    """The same with all touched pixels free, as a histogram over the whole raster."""
    occupied, free = nav_layers(spark, sf)
    grid = nav_grid(spark, sf)
    return raster.occupancy_histogram(raster.paint_occupancy(occupied, free, grid, True), grid, K.OCCUPIED)


@query
def occupancy_codes(spark: SparkSession, sf: str) -> DataFrame:
    px, n = px_dense(spark, sf)
    v = F.col("v")
    color = raster.colorize(v)
    return px.select(
        "row", "col", raster.occupancy_cost(v).alias("cost"), raster.roads_only(v).alias("roads_only"),
        raster.binary_cost(v == K.FREE).alias("binary_cost"), color["r"].alias("r"), color["g"].alias("g"),
        color["a"].alias("a"),
    )


@query
def occupancy_histogram(spark: SparkSession, sf: str) -> DataFrame:
    px, n = px_frame(spark, sf)
    return raster.occupancy_histogram(px, raster.Grid(0.0, 0.0, 1.0, n, n))


@query
def downsample_occupancy(spark: SparkSession, sf: str) -> DataFrame:
    px, n = px_dense(spark, sf)
    plain = raster.downsample(px, 3).withColumnRenamed("v", "plain")
    binary = raster.downsample(px, 3, True).withColumnRenamed("v", "binary")
    return plain.join(binary, ["row", "col"]).join(raster.downsample_bundle(px, 3).withColumnRenamed("v", "bundle"), ["row", "col"])


@query
def shrink_nearest(spark: SparkSession, sf: str) -> DataFrame:
    px, n = px_dense(spark, sf)
    return raster.shrink_nearest(px, n, n, max(2, 2 * n // 5))


@query
def distance_transform(spark: SparkSession, sf: str) -> DataFrame:
    free, n = free_mask(spark, sf)
    return raster.nearest_sites(free, ~F.col("free"), n).select("row", "col", "d2")


@query
def close_and_dilate(spark: SparkSession, sf: str) -> DataFrame:
    free, n = free_mask(spark, sf)
    closed = raster.close_gaps(free, n, n, raster.radius_px(1.5, 1.0)).withColumnRenamed("free", "closed")
    return closed.join(raster.dilate(free, n, 2).withColumnRenamed("free", "dilated"), ["row", "col"])


@query
def soft_cost(spark: SparkSession, sf: str) -> DataFrame:
    free, n = free_mask(spark, sf)
    return raster.soft_cost(free, n, 1.0, 3.0)


@query
def planner_cost(spark: SparkSession, sf: str) -> DataFrame:
    px, n = px_dense(spark, sf)
    return raster.mppi_cost(px, n, n, 1.0, 1.5, 1.0, 3.0)


@query
def widen_corridors(spark: SparkSession, sf: str) -> DataFrame:
    free, n = free_mask(spark, sf)
    return raster.widen_corridors(free, n, 1.6)


@query
def relief_and_slope(spark: SparkSession, sf: str) -> DataFrame:
    n = fx.pixel_side(spark, sf)
    px = raster.dense(fx.pixels(spark, sf).select("row", "col", "z"), n, n, z=float("nan"))
    gray, _, scale = raster.relief(px, n, n)
    slope = raster.slope_occupancy(gray, fx.ELEVATION_RES_M, scale, 0.05)
    return gray.select("row", "col", "gray").join(slope, ["row", "col"])


@query
def height_quantized(spark: SparkSession, sf: str) -> DataFrame:
    px = fx.pixels(spark, sf).select("row", "col", "z")
    low, high = raster.value_range(px)
    return raster.quantize(px, low, high).select("row", "col", "q")


SRC = {"west": 121.5, "north": 25.06, "step": 0.0001}


@query
def reproject_elevation(spark: SparkSession, sf: str) -> DataFrame:
    """Lon/lat elevation sampled bilinearly on the 10 m UTM grid that covers the whole source."""
    n = fx.pixel_side(spark, sf)
    px = fx.pixels(spark, sf).select("row", "col", "z")
    span, epsg = n * SRC["step"], 32651
    left, top, nrows, ncols = raster.utm_target(spark, SRC["west"], SRC["north"] - span, SRC["west"] + span, SRC["north"], epsg, 10.0)
    out = raster.reproject(px, SRC["west"], SRC["north"], SRC["step"], n, n, epsg, left, top, 10.0, 10.0, nrows, ncols)
    return out.select("row", "col", rnd("z", 4).alias("z"))


@query
def square_heights(spark: SparkSession, sf: str) -> DataFrame:
    n = fx.pixel_side(spark, sf)
    px = raster.dense(fx.pixels(spark, sf).select("row", "col", "z"), n, n, z=100.0)
    low, high = raster.value_range(px)
    return raster.resample_square(raster.quantize(px, low, high), n, n, 2 * n + 1)


@query
def ortho_bands(spark: SparkSession, sf: str) -> DataFrame:
    px = fx.pixels(spark, sf)
    bands = F.array(
        F.struct(F.lit(1).alias("band"), (F.col("v") * 3.0).alias("value")), F.struct(F.lit(2).alias("band"), F.col("z").alias("value"))
    )
    rows = raster.ortho_bands(px.select("row", "col", F.inline(bands)))
    return rows.groupBy("band", "value").agg(F.count("*").alias("n"))


# ---- scenes and assets


@query
def box_relations(spark: SparkSession, sf: str) -> DataFrame:
    s = fx.scene_sources(spark, sf).where("osm_box is not null and dem_box is not null")
    a, b = F.col("osm_box"), F.col("dem_box")
    common = frame.box_intersection(a, b)
    return s.select(
        "scene", frame.box_relation(a, b).alias("relation"), frame.box_relation_label(a, b).alias("label"),
        frame.box_contains(a, b).alias("contains"), rnd(frame.box_area(a)).alias("area"),
        rnd(F.coalesce(common["west"], F.lit(0.0))).alias("west"), rnd(F.coalesce(common["north"], F.lit(0.0))).alias("north"),
        rnd(frame.box_pad(a, 0.01)["south"]).alias("padded_south"),
    )


@query
def resolved_extents(spark: SparkSession, sf: str) -> DataFrame:
    rows = extent.resolve_extent(fx.scene_sources(spark, sf))
    value = lambda c: rnd(F.coalesce(F.col(f"final.{c}"), F.lit(0.0)))
    return rows.select(
        "scene", *[value(c).alias(c) for c in ("west", "south", "east", "north")], "strategy", "osm_vs_terrain",
        F.array_join("warnings", "; ").alias("warnings"), F.size("errors").cast("long").alias("n_errors"),
    )


@query
def local_extents(spark: SparkSession, sf: str) -> DataFrame:
    """Local extents, raster sizes and pixel spacing of the scenes' map boxes."""
    s = fx.scene_sources(spark, sf).where("osm_box is not null")
    o = frame.make_origin(121.5, 25.0)
    s = s.withColumn("e", frame.extent_from_bbox(*[F.col(f"osm_box.{c}") for c in ("west", "south", "east", "north")], o))
    s = s.withColumn("wide", F.col("e.east") - F.col("e.west")).withColumn("high", F.col("e.north") - F.col("e.south"))
    s = s.withColumn("px", frame.odd_size(F.col("wide"), F.col("high"), K.HEIGHT_SIDE_PX))
    s = s.withColumn("mpp", frame.metres_per_pixel(F.col("wide"), F.col("high"), F.col("px.nx"), F.col("px.ny")))
    return s.select(
        "scene", *[rnd(f"e.{c}", 3).alias(c) for c in ("west", "south", "east", "north")],
        F.col("px.nx").cast("long").alias("nx"), F.col("px.ny").cast("long").alias("ny"), rnd("mpp.x", 5).alias("mx"),
    )


@query
def raster_boxes(spark: SparkSession, sf: str) -> DataFrame:
    """Lon/lat boxes of 1 km UTM tiles, one per customer."""
    c = F.col("c_custkey")
    left, bottom = 300000.0 + (c % 50) * 1000.0, 2700000.0 + F.floor(c / 50) * 1000.0
    tiles = fx.table(spark, sf, "customer").select(
        c.alias("scene"), left.alias("left"), bottom.alias("bottom"), (left + 1000.0).alias("right"),
        (bottom + 1000.0).alias("top"), F.lit(32651).alias("epsg"),
    )
    return extent.raster_boxes(tiles).select("scene", *[rnd(f"box.{k}", 7).alias(k) for k in ("west", "south", "east", "north")])


@query
def scene_inputs(spark: SparkSession, sf: str) -> DataFrame:
    rows = extent.choose_inputs(fx.file_listing(spark, sf))
    return rows.select("scene", *[F.coalesce(c, F.lit("")).alias(c) for c in ("osm", "dem", "imagery")])


@query
def asset_rules(spark: SparkSession, sf: str) -> DataFrame:
    none = F.lit("")
    rows = assets.with_folder(fx.assets(spark, sf))
    path = F.concat(F.lit("inbox/"), F.col("folder"), F.lit("/"), F.col("file"))
    return rows.select(
        "page_id", F.coalesce(assets.low_rise_role(F.col("file")), none).alias("low_rise"),
        F.coalesce(assets.sheet_role(F.col("file")), none).alias("sheet"),
        F.coalesce(assets.free_license(F.col("license")), none).alias("free"), "folder", assets.uv_mode(path).alias("uv_mode"),
    )


@query
def asset_violations(spark: SparkSession, sf: str) -> DataFrame:
    return assets.violations(fx.assets(spark, sf))


@query
def asset_counts(spark: SparkSession, sf: str) -> DataFrame:
    return assets.catalogue_counts(fx.assets(spark, sf))


@query
def plain_html(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "pages").select("page_id", assets.strip_html(F.col("html")).alias("text"))


@query
def searched_photos(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.assets(spark, sf).withColumn("pos", F.col("page_id"))
    return assets.searched_photos(rows.select("pos", "title", "query", "license", "width", "height"))


def inbox_photos(spark: SparkSession, sf: str) -> DataFrame:
    """Photos filed in the browse folders; every tenth page lists the path of its neighbour again."""
    rows = assets.with_folder(fx.assets(spark, sf))
    owner = F.col("page_id") - F.when(F.col("page_id") % 10 == 1, 1).otherwise(0)
    path = F.concat(F.lit("/inbox/facades/sheets/"), owner.cast("string"), F.lit(".jpg"))
    return rows.select("folder", F.concat(F.col("page_id").cast("string"), F.lit("_"), F.col("file")).alias("name"), path.alias("path"))


@query
def photo_pools(spark: SparkSession, sf: str) -> DataFrame:
    return assets.pooled_photos(inbox_photos(spark, sf)).select("pool", F.col("n").cast("long").alias("n"), "path")


@query
def low_rise_slots(spark: SparkSession, sf: str) -> DataFrame:
    rows = assets.bind_low_slots(inbox_photos(spark, sf))
    return rows.select(F.col("slot").cast("long").alias("slot"), "path", "uv_mode")


@query
def band_photos(spark: SparkSession, sf: str) -> DataFrame:
    """Cached facade photos per band; stems follow the page number over the fixed name range."""
    p = F.col("page_id")
    rows = fx.table(spark, sf, "pages").select(
        F.format_string("Facade%03d", (p % 25).cast("int")).alias("stem"), F.format_string("/cache/%05d.jpg", p).alias("path")
    )
    return assets.photos_by_band(rows).select("band", F.col("n").cast("long").alias("n"), "path")


# ---- roads, markings, junctions


@query
def strips_cut_by_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Straight road strips minus the strips before them in rank order, area left per strip."""
    strips = roads.motor_strips(fx.ways(spark, sf))
    key = F.col("ord") * 2 + F.col("run")
    cut = roads.cut_by_rank(strips.withColumn("key", key), "key")
    area = kernel.parts_area(F.col("parts"))
    return cut.select("osm_id", F.col("run").cast("long").alias("run"), rnd(area, 3).alias("area"))


@query
def merged_chains(spark: SparkSession, sf: str) -> DataFrame:
    ways = road_table(spark, sf)
    rows = roads.merge_chains(ways.where(tags.is_bufferable()), roads.node_degree(ways))
    return rows.select(
        "osm_id", "ord", F.size("coords").alias("n_vertices"), rnd(lines.length(F.col("coords")), 3).alias("len"), "closed"
    )


@query
def pavement_area(spark: SparkSession, sf: str) -> DataFrame:
    rows = roads.pavement(fx.ways(spark, sf))
    return rows.select("osm_id", "ord", F.size("coords").alias("n_vertices"), rnd(kernel.parts_area(F.col("parts")), 2).alias("area"))


@query
def blended_widths(spark: SparkSession, sf: str) -> DataFrame:
    """Stations of ways whose vertices alternate between two widths."""
    w = F.transform("coords", lambda p, i: F.lit(6.0) + i % 2 * (F.col("osm_id") % 13))
    rows = fx.ways(spark, sf).select("osm_id", "ord", F.posexplode(F.arrays_zip("coords", w.alias("w"))).alias("i", "v"))
    rows = rows.select("ord", "i", F.lit(0).alias("k"), "v.coords.x", "v.coords.y", "v.w")
    out = ribbons.blended(rows).groupBy("ord").agg(
        F.count("*").alias("n_stations"), rnd(F.sum("w"), 3).alias("sum_width"), rnd(F.min("w"), 4).alias("least"), rnd(F.max("w"), 4).alias("most")
    )
    return out.withColumnRenamed("ord", "osm_id")


@query
def ribbon_area(spark: SparkSession, sf: str) -> DataFrame:
    """Strips and area of each single way with its corner rounded."""
    ways = fx.ways(spark, sf).withColumn("widths", F.array_repeat(tags.road_width(), F.size("coords")))
    rows = ribbons.strips(ribbons.rounded(ways).withColumn("m", F.lit(1)))
    return rows.groupBy(F.col("ord").alias("osm_id")).agg(F.count("*").alias("n_strips"), rnd(F.sum(lines.ring_area(F.col("part"))), 2).alias("area"))


def piece_ends(rows: DataFrame) -> DataFrame:
    p = F.col("piece")
    return rows.select(
        "osm_id", rnd(lines.length(p), 3).alias("len"), rnd(lines.first(p)["x"], 3).alias("x0"), rnd(lines.first(p)["y"], 3).alias("y0"),
        rnd(lines.last(p)["x"], 3).alias("x1"), rnd(lines.last(p)["y"], 3).alias("y1"),
    )


@query
def pieces_between_junctions(spark: SparkSession, sf: str) -> DataFrame:
    ways = road_table(spark, sf)
    return piece_ends(markings.split_at_junctions(ways, roads.node_degree(ways)))


@query
def pieces_off_vertices(spark: SparkSession, sf: str) -> DataFrame:
    """The same ways without the vertices on their straight runs, so most junction nodes lie between vertices."""
    ways = road_table(spark, sf)
    bare = ways.withColumn("coords", lines.merge_straight(F.col("coords")))
    return piece_ends(markings.split_at_junctions(bare, roads.node_degree(ways)))


@query
def repaired_outlines(spark: SparkSession, sf: str) -> DataFrame:
    """Valid parts of outlines that cross themselves (bow ties), touch themselves at a vertex, or do neither."""
    x0, y0, x1, y1 = (F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1"))
    mx, my = (x0 + x1) / 2, (y0 + y1) / 2
    box = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    bow = [(x0, y0), (x1, y1), (x1, y0), (x0, y1), (x0, y0)]
    eight = [(x0, y0), (mx, my), (x0, y1), (x1, y1), (mx, my), (x1, y0), (x0, y0)]
    shape = lambda points: F.array(*[lines.pt(x, y) for x, y in points])
    ring = F.when(F.col("osm_id") % 3 == 0, shape(bow)).when(F.col("osm_id") % 3 == 1, shape(eight)).otherwise(shape(box))
    rows = kernel.repair_rings(fx.building_boxes(spark, sf).select("osm_id", ring.alias("ring")))
    return rows.select("osm_id", F.col("part_no").cast("int").alias("part_no"), rnd(lines.ring_area(F.col("ring")), 3).alias("area"), rnd("others", 3).alias("others"))


def straight_stripes(spark: SparkSession, sf: str) -> DataFrame:
    """Stripes of all ways' straight runs (one piece per run)."""
    ways = fx.ways(spark, sf).withColumn("coords", lines.merge_straight(F.col("coords")))
    ways = lines.finished(ways.select("osm_id", "ord", "tags", lines.segments(F.col("coords")).alias("runs")), "runs")
    runs = ways.select("osm_id", "ord", "tags", F.posexplode("runs").alias("piece_no", "s"))
    piece = F.array(lines.pt(F.col("s.x0"), F.col("s.y0")), lines.pt(F.col("s.x1"), F.col("s.y1")))
    runs = runs.withColumn("piece", piece).withColumn("piece_widths", F.array_repeat(tags.road_width(), F.size("piece")))
    return markings.dash(markings.marking_lines(runs))


@query
def marking_stripes(spark: SparkSession, sf: str) -> DataFrame:
    rows = straight_stripes(spark, sf)
    c = F.col("line")
    return rows.select(
        "osm_id", F.col("piece_no").cast("long").alias("piece_no"), "role", "style", F.col("seq").cast("long").alias("seq"),
        rnd(lines.length(c), 3).alias("len"), rnd(lines.vertex_mean(c)["x"], 3).alias("x"), rnd(lines.vertex_mean(c)["y"], 3).alias("y"),
    )


@query
def marking_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Painted pieces per colour and cell."""
    strips = straight_stripes(spark, sf).withColumn("parts", lines.segment_boxes(F.col("line"), F.lit(K.MARKING_BUFFER_M)))
    rows = mesh.marking_buckets(strips)
    return rows.select("color", "cell", "n", rnd("area", 2).alias("area"))


@query
def junction_candidates(spark: SparkSession, sf: str) -> DataFrame:
    ways = fx.ways(spark, sf)
    rows = junctions.junction_candidates(ways, roads.node_degree(ways))
    return rows.groupBy("nx", "ny").agg(
        F.count("*").alias("n_ways"), rnd(F.max("width"), 2).alias("width"), F.sum(F.size("arms")).alias("n_arms")
    )


@query
def typed_junctions(spark: SparkSession, sf: str) -> DataFrame:
    ways = fx.ways(spark, sf)
    rows = junctions.typed_junctions(ways, roads.node_degree(ways))
    return rows.select("kind", rnd("x", 3).alias("x"), rnd("y", 3).alias("y"), rnd("width", 2).alias("width"), rnd("clip_r", 2).alias("clip_r"))


@query
def zebra_stripes(spark: SparkSession, sf: str) -> DataFrame:
    ways = fx.ways(spark, sf)
    rows = junctions.zebra_stripes(junctions.typed_junctions(ways, roads.node_degree(ways)))
    return rows.select(rnd("x", 3).alias("x"), rnd("y", 3).alias("y"), rnd(lines.ring_area(F.col("ring")), 4).alias("area"))


@query
def approach_arrows(spark: SparkSession, sf: str) -> DataFrame:
    """Arrows before thinning, one per spot."""
    ways = fx.ways(spark, sf)
    rows = junctions.first_per_spot(junctions.approach_arrows(ways, roads.node_degree(ways)))
    return rows.select("osm_id", F.col("pos").cast("long").alias("pos"), F.col("step").cast("long").alias("step"),
                       rnd("x", 3).alias("x"), rnd("y", 3).alias("y"), rnd("yaw", 6).alias("yaw"))


@query
def junction_arrows(spark: SparkSession, sf: str) -> DataFrame:
    ways = road_table(spark, sf)
    degree = stored(roads.node_degree(ways))  # the approaches and the junctions both read it
    rows = junctions.junction_arrows(ways, degree, junctions.typed_junctions(ways, degree))
    return rows.select("osm_id", "pos", "step", rnd("x", 3).alias("x"), rnd("y", 3).alias("y"), rnd("yaw", 6).alias("yaw"),
                       rnd(lines.ring_area(junctions.arrow_ring()), 3).alias("area"))


@query
def roundabout_patches(spark: SparkSession, sf: str) -> DataFrame:
    rows = junctions.roundabout_patches(fx.ways(spark, sf))
    return rows.select("osm_id", F.size("parts").alias("n_parts"), rnd("x", 3).alias("x"), rnd("y", 3).alias("y"))


@query
def road_buffers(spark: SparkSession, sf: str) -> DataFrame:
    """Area of the round-ended motor road buffers."""
    buffers = roads.motor_buffers(fx.ways(spark, sf)).withColumnRenamed("parts", "pieces")
    rows = kernel.add(buffers, "parts", kernel.disjoint_parts, "pieces")
    return rows.select("osm_id", rnd(kernel.parts_area(F.col("parts")), 3).alias("area"))


# ---- overlay and meshes


@query
def areas_cut_by_buildings(spark: SparkSession, sf: str) -> DataFrame:
    """Water and vegetation minus all buildings, cut exactly."""
    ways = fx.boxes_to_ways(fx.area_boxes(spark, sf))
    areas = overlay.water_areas(ways).unionByName(overlay.vegetation_areas(ways))
    cut = overlay.cut_by(areas, box_parts(fx.building_boxes(spark, sf)))
    return cut.select("osm_id", rnd(kernel.parts_area(F.col("parts")), 3).alias("area"))


@query
def area_cutters(spark: SparkSession, sf: str) -> DataFrame:
    """How many buildings touch each water or vegetation area."""
    ways = fx.boxes_to_ways(fx.area_boxes(spark, sf))
    areas = overlay.water_areas(ways).unionByName(overlay.vegetation_areas(ways))
    hits = overlay.touching(areas, box_parts(fx.building_boxes(spark, sf)))
    return hits.groupBy(F.col("a_id").alias("osm_id")).agg(F.count_distinct("c_id").alias("n_buildings"))


@query
def nav_layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Areas of the connected navigation layers with plain footprints."""
    ways = fx.ways(spark, sf).unionByName(fx.buildings(spark, sf))
    ways = ways.unionByName(fx.boxes_to_ways(fx.area_boxes(spark, sf)))
    occupied, free = overlay.nav_layers(ways, simple_buildings=True)
    return osm.layer_counts(occupied=occupied, free=free)


@query
def road_strip_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Road pieces and area per surface and cell."""
    rows = mesh.road_buckets(roads.motor_strips(fx.ways(spark, sf)))
    return rows.select("surface", "cell", rnd("z_m", 3).alias("z_m"), "n", rnd("area", 2).alias("area"))


@query
def wall_quads(spark: SparkSession, sf: str) -> DataFrame:
    rows = mesh.wall_quads(city_items(spark, sf))
    return rows.select(
        "osm_id", F.col("wall").cast("long").alias("wall"), *[rnd(c, 3).alias(c) for c in ("x0_cm", "y0_cm", "x1_cm", "y1_cm", "z1_cm")],
        rnd("u0", 6).alias("u0"), rnd("u1", 6).alias("u1"), rnd("v1", 6).alias("v1"),
    )


@query
def mesh_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Point and face offsets of each building inside its merged (cell, band, variant) mesh."""
    items = buildings.with_lod_cell(city_items(spark, sf)).withColumn("band", tags.facade_band(F.col("height_m")))
    items = items.withColumn("variant", tags.facade_variant(F.col("osm_id"), F.col("band")))
    n = F.size("ring") - 1
    sized = items.withColumn("points", n + 4 * n).withColumn("faces", n - 2 + n)
    rows = mesh.point_offsets(sized, ["cell", "band", "variant"], "ord", "points", "faces")
    return rows.select("osm_id", "point_offset", "face_offset")


@query
def roof_triangles(spark: SparkSession, sf: str) -> DataFrame:
    """Triangles and roof area of the inset footprints."""
    items = buildings.inset(buildings.footprints(fx.buildings(spark, sf)))
    tri = mesh.triangulate(overlay.ring_to_parts(items).select("osm_id", "parts"))
    return tri.groupBy("osm_id").agg(
        F.count("*").alias("n"), rnd(F.sum(lines.ring_area(F.concat("t", F.slice("t", 1, 1)))), 3).alias("area")
    )


@query
def wall_uvs(spark: SparkSession, sf: str) -> DataFrame:
    """Planar texture coordinates of each building's lower and upper corners."""
    b = fx.building_boxes(spark, sf).withColumn("height_m", tags.building_height())
    corner = lambda x, y, z: F.struct(F.col(x).alias("x"), F.col(y).alias("y"), z.alias("z"))
    zero, top = F.lit(0.0), F.col("height_m")
    points = b.select("osm_id", F.inline(F.array(corner("x0", "y0", zero), corner("x1", "y0", top), corner("x1", "y1", zero))))
    return mesh.planar_uvs(points, "osm_id").select("osm_id", "x", "y", "z", rnd("u").alias("u"), rnd("v").alias("v"))


@query
def cell_masses(spark: SparkSession, sf: str) -> DataFrame:
    """Union of the footprints per 100 m cell."""
    rows = mesh.union_footprints(city_items(spark, sf), 100.0)
    return rows.select("cell", rnd(kernel.parts_area(F.col("parts")), 2).alias("area"), rnd("height_m", 2).alias("height_m"))
