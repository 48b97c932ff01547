"""Water and vegetation areas, their cut by buildings, and the navigation polygon sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanweave.functions import kernel, lines, tags
from urbanweave.operators import buildings, roads, spatial
from urbanweave.operators.buildings import _boxed
from urbanweave.session import cut_lineage

AREA_CELL_M = 100.0


def closed_areas(ways: DataFrame) -> DataFrame:
    """Closed ways as convex parts: all that an outline encloses an odd number of times, also where it crosses itself."""
    closed = ways.where(F.col("closed") & (F.size("coords") >= 4))
    parts = ring_to_parts(closed.select("osm_id", "ord", "tags", F.col("coords").alias("ring")))
    return parts.where(F.size("parts") > 0).select("osm_id", "ord", "tags", "parts")


def water_areas(ways: DataFrame) -> DataFrame:
    """Water areas, and waterways widened by their kind."""
    areas = closed_areas(ways.where(tags.is_water_area()))
    rivers = ways.where(~tags.is_water_area() & tags.is_waterway() & (F.size("coords") >= 2))
    rivers = rivers.where(lines.length(F.col("coords")) > 0)
    buffer = lines.buffer_parts(F.col("coords"), tags.waterway_width() / 2)
    buffered = kernel.add(rivers, "parts", kernel.disjoint_parts, buffer)
    return areas.unionByName(buffered.select("osm_id", "ord", "tags", "parts"))


def vegetation_areas(ways: DataFrame) -> DataFrame:
    return closed_areas(ways.where(tags.is_vegetation()))


def touching(areas: DataFrame, cutters: DataFrame) -> DataFrame:
    """Cutters that touch a part of an area: ``(a_id, part_no, c_id, c_part, overlaps)``."""
    pieces = cutters.select(F.col("osm_id").alias("c_id"), F.explode("parts").alias("c_part"))
    right = _boxed(pieces, lines.bounds(F.col("c_part")))
    parts = areas.select(F.col("osm_id").alias("a_id"), F.posexplode("parts").alias("part_no", "part"))
    left = _boxed(parts, lines.bounds(F.col("part")))
    pairs = spatial.box_join(left, right, AREA_CELL_M)
    open_box = (F.least("l_x1", "r_x1") > F.greatest("l_x0", "r_x0")) & (F.least("l_y1", "r_y1") > F.greatest("l_y0", "r_y0"))
    apart = F.array_min(
        F.transform(lines.segments(F.col("c_part")), lambda s: lines.ring_segment_distance(F.col("part"), s))
    )
    boxes = lines.is_box(F.col("part")) & lines.is_box(F.col("c_part"))
    inside = lines.point_in_ring(lines.first(F.col("part"))["x"], lines.first(F.col("part"))["y"], F.col("c_part"))
    meets = F.when(boxes, F.lit(True)).otherwise((apart <= 0) | inside)
    return pairs.where(meets).select("a_id", "part_no", "c_id", "c_part", open_box.alias("overlaps"))


def cut_by(areas: DataFrame, cutters: DataFrame) -> DataFrame:
    """Areas minus all cutters that touch them; emptied areas drop out."""
    hits = touching(areas, cutters)
    by_part = hits.where("overlaps").select("a_id", "part_no", "c_part").distinct()
    by_part = by_part.groupBy("a_id", "part_no").agg(F.collect_list("c_part").alias("cutters"))
    exploded = areas.select("osm_id", F.posexplode("parts").alias("part_no", "part"))
    joined = exploded.join(
        by_part, (exploded["osm_id"] == by_part["a_id"]) & (exploded["part_no"] == by_part["part_no"]), "left"
    )
    whole = joined.where(F.col("cutters").isNull()).select("osm_id", F.array("part").alias("left"))
    cut = kernel.add(joined.where(F.col("cutters").isNotNull()), "left", kernel.difference, F.array("part"), "cutters")
    cut = cut.select("osm_id", "left")
    remains = whole.unionByName(cut).groupBy("osm_id").agg(F.flatten(F.collect_list("left")).alias("parts"))
    return areas.drop("parts").join(remains, "osm_id").where(F.size("parts") > 0)


def subtract_discs(shapes: DataFrame, discs: DataFrame) -> DataFrame:
    """Shapes minus every disc (or other parts) that touches them."""
    return cut_by(shapes, discs)


def ring_to_parts(items: DataFrame) -> DataFrame:
    """Add the convex ``parts`` of each ``ring``. One pass: Python sees an empty list for a rectangle."""
    other = F.when(~lines.is_box(F.col("ring")), F.col("ring")).otherwise(kernel.none_of("ring"))
    marked = items.withColumn("_box", lines.is_box(F.col("ring")))
    cut = kernel.add(marked, "parts", kernel.ring_parts, other)
    whole = F.coalesce("_box", F.lit(True))
    return cut.withColumn("parts", F.when(whole, F.array("ring")).otherwise(F.col("parts"))).drop("_box")


def nav_layers(
    ways: DataFrame, connected: bool = True, simple_buildings: bool = False, use_buildings: bool = True,
    use_water: bool = True, use_roads: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Occupied and free areas of the navigation raster, each ``(osm_id, parts)``.

    Occupied are buildings and uncut water. Free are the motor roads: flat-ended buffers when ``connected``, else the
    rank-cut pavement (or round buffers when that is empty).
    """
    empty = ways.select("osm_id", F.array("coords").alias("parts")).where(F.lit(False))
    occupied, free = empty, empty
    if use_buildings:
        items = buildings.simple_footprints(ways) if simple_buildings else buildings.build(ways)
        occupied = occupied.unionByName(ring_to_parts(items).select("osm_id", "parts"))
    if use_water:
        occupied = occupied.unionByName(water_areas(ways).select("osm_id", "parts"))
    if use_roads:
        highways = ways.where(tags.highway() != "")
        if connected:
            free = roads.motor_buffers(highways, "flat")
        else:
            free = cut_lineage(roads.cut_by_rank(roads.pavement(highways)).where(tags.is_motor()))
            if free.isEmpty():
                free = roads.motor_buffers(ways)
        free = free.select("osm_id", "parts")
    return occupied, free
