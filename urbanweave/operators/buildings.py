"""Building footprints: carriageway test, inset, removal of enclosed ones, level-of-detail cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import kernel, lines, tags
from urbanweave.operators import spatial
from urbanweave.session import cut_lineage

BUILDING_CELL_M = 100.0


def carriageway_segments(ways: DataFrame, scale: float = 1.0, step: float = K.CARRIAGEWAY_SEGMENT_M) -> DataFrame:
    """Motor roads cut into pieces of at most ``step`` metres: ``(osm_id, seg, coords, half)``."""
    motor = ways.where(tags.is_motor() & (F.size("coords") >= 2)).withColumn("len", lines.length(F.col("coords")))
    count = F.greatest(F.lit(1), F.ceil((F.col("len") - 1e-6) / F.lit(float(step)))).cast("int")
    cut = motor.where("len > 0").select(
        "osm_id", "coords", "len", (tags.road_width(scale=scale) / 2).alias("half"),
        F.explode(F.sequence(F.lit(0), count - 1)).alias("seg"),
    )
    start = F.col("seg") * F.lit(float(step))
    piece = lines.sub_line(F.col("coords"), start, F.least(start + float(step), F.col("len")))
    whole = F.col("len") <= step
    return cut.select("osm_id", "seg", F.when(whole, F.col("coords")).otherwise(piece).alias("coords"), "half")


def footprints(building_ways: DataFrame) -> DataFrame:
    """Closed building ways with a valid ring: ``(osm_id, ord, tags, ring, part_no, others)``.

    An outline that meets itself gives a row per valid part, with the area of its other parts.
    """
    closed = building_ways.where(tags.has_tag("building") & F.col("closed") & (F.size("coords") >= 4))
    return kernel.repair_rings(closed.select("osm_id", "ord", "tags", F.col("coords").alias("ring")))


def _boxed(df: DataFrame, bounds: Column, pad: Column | float = 0.0) -> DataFrame:
    """Add the corners of a row's (padded) bounding box."""
    pad = pad if isinstance(pad, Column) else F.lit(float(pad))
    boxed = df.withColumn("_b", bounds)
    return boxed.select(
        *df.columns,
        (F.col("_b.x0") - pad).alias("x0"), (F.col("_b.y0") - pad).alias("y0"),
        (F.col("_b.x1") + pad).alias("x1"), (F.col("_b.y1") + pad).alias("y1"),
    )


def carriageway_hits(rings: DataFrame, segments: DataFrame) -> DataFrame:
    """Ids of footprints nearer to a motor segment's middle line than its half width."""
    boxed = _boxed(rings.select("osm_id", "ring"), lines.bounds(F.col("ring")))
    # the join reads both sides twice; a rectangle is written without its outline
    left = cut_lineage(boxed.withColumn("ring", F.when(~lines.is_box(F.col("ring")), F.col("ring"))))
    pieces = segments.select(F.explode(lines.segments(F.col("coords"))).alias("s"), "half")
    ends = F.struct(
        F.least("s.x0", "s.x1").alias("x0"), F.least("s.y0", "s.y1").alias("y0"),
        F.greatest("s.x0", "s.x1").alias("x1"), F.greatest("s.y0", "s.y1").alias("y1"),
    )
    right = cut_lineage(_boxed(pieces, ends, F.col("half")))
    pairs = spatial.box_join(left, right, BUILDING_CELL_M)
    pairs = pairs.withColumn("ring", F.coalesce("ring", lines.box_ring(*[F.col(f"l_{c}") for c in ("x0", "y0", "x1", "y1")])))
    # the gap of the boxes is a cheap lower bound; the case keeps the exact distance behind it
    gap_x = F.greatest(F.lit(0.0), F.least("s.x0", "s.x1") - F.col("l_x1"), F.col("l_x0") - F.greatest("s.x0", "s.x1"))
    gap_y = F.greatest(F.lit(0.0), F.least("s.y0", "s.y1") - F.col("l_y1"), F.col("l_y0") - F.greatest("s.y0", "s.y1"))
    reach = F.col("half") - 1e-6
    near = F.when(gap_x * gap_x + gap_y * gap_y < reach * reach, lines.ring_segment_distance(F.col("ring"), F.col("s")) < reach)
    return pairs.where(F.coalesce(near, F.lit(False))).select("osm_id").distinct()


def polygon_hits(rings: DataFrame, roads: DataFrame) -> DataFrame:
    """Ids of footprints that touch a road polygon; ``roads`` has convex ``parts``."""
    left = _boxed(rings.select("osm_id", "ring"), lines.bounds(F.col("ring")))
    pieces = roads.select(F.explode("parts").alias("part"))
    right = _boxed(pieces, lines.bounds(F.col("part")))
    pairs = spatial.box_join(left, right, BUILDING_CELL_M)
    edge = F.array_min(
        F.transform(lines.segments(F.col("part")), lambda s: lines.ring_segment_distance(F.col("ring"), s))
    )
    inside = lines.point_in_ring(lines.first(F.col("ring"))["x"], lines.first(F.col("ring"))["y"], F.col("part"))
    return pairs.where((edge <= 0) | inside).select("osm_id").distinct()


def inset(rings: DataFrame) -> DataFrame:
    """Move the walls inwards a little; keep the ring where that fails; drop footprints that are too small with all their parts."""
    inner = F.coalesce(lines.inset_ring(F.col("ring"), K.FOOTPRINT_INSET_M), F.col("ring"))
    sized = rings.withColumn("ring", inner).withColumn("area", lines.ring_area(F.col("ring")))
    others = F.col("others") if "others" in rings.columns else F.lit(0.0)
    return sized.where(F.col("area") + others >= K.MIN_FOOTPRINT_AREA_M2)


def footprints_after_roads(building_ways: DataFrame, segments: DataFrame) -> DataFrame:
    """Footprints clear of the carriageways, inset, with area and height."""
    rings = footprints(building_ways)
    clear = rings.join(carriageway_hits(rings, segments), "osm_id", "left_anti")
    return inset(clear).withColumn("height_m", tags.building_height())


def cover_pairs(shapes: DataFrame, ratio: float = K.ENCLOSED_COVER_RATIO) -> DataFrame:
    """Pairs ``(i, j)`` of different shapes where ``j`` covers at least ``ratio`` of ``i`` and is not smaller.

    ``shapes`` is ``(shape, ring, area)``. Rectangles are judged in closed form, other rings in an Arrow kernel.
    """
    boxed = _boxed(shapes, lines.bounds(F.col("ring"))).withColumn("box", lines.is_box(F.col("ring")))
    # the join reads both sides twice; a rectangle is written without its outline
    boxed = cut_lineage(boxed.withColumn("ring", F.when(~F.col("box"), F.col("ring"))))
    left = boxed.select(*[F.col(c).alias(f"i_{c}") for c in ("shape", "ring", "area", "box")], "x0", "y0", "x1", "y1")
    right = boxed.select(*[F.col(c).alias(f"j_{c}") for c in ("shape", "ring", "area", "box")], "x0", "y0", "x1", "y1")
    width = F.least("l_x1", "r_x1") - F.greatest("l_x0", "r_x0")
    height = F.least("l_y1", "r_y1") - F.greatest("l_y0", "r_y0")

    def candidate(left_of, right_of) -> Column:
        bigger = right_of("j_area") >= left_of("i_area") - 1e-6
        return (left_of("i_shape") != right_of("j_shape")) & bigger & (width * height >= ratio * left_of("i_area"))

    pairs = spatial.box_join(left, right, BUILDING_CELL_M, condition=candidate)
    both = F.col("i_box") & F.col("j_box")

    def outline(side: str, box: str) -> Column:
        whole = F.coalesce(f"{side}_ring", lines.box_ring(*[F.col(f"{box}_{c}") for c in ("x0", "y0", "x1", "y1")]))
        return F.when(both, F.slice(whole, 1, 0)).otherwise(whole)

    judged = kernel.add(pairs, "exact", kernel.overlap_area, outline("i", "l"), outline("j", "r"))
    common = F.when(both, width * height).otherwise(F.col("exact"))
    covered = judged.where(common >= ratio * F.col("i_area"))
    larger = F.col("j_area") > F.col("i_area") + 1e-6
    return covered.select("i_shape", "j_shape", larger.alias("larger"))


def enclosed_ids(items: DataFrame) -> DataFrame:
    """Ids of the footprints that a pass in file order drops as covered by a kept (or later, larger) one.

    Copies of one outline form a shape first, so copies never pair with each other. A member of a shape can only
    stay if no larger cover comes later in the file, hence only the first member after the last larger cover is a
    candidate; every other member is dropped. Candidates then block each other in file order. A building of several
    parts stays with all of them if one stays.
    """
    shape = F.md5(F.col("ring").cast("string"))
    keyed = cut_lineage(items.select("osm_id", "ord", "ring", "area", shape.alias("shape")))
    shapes = keyed.groupBy("shape").agg(
        F.first("ring").alias("ring"), F.first("area").alias("area"), F.max("ord").alias("last_ord")
    )
    pairs = cut_lineage(cover_pairs(shapes.select("shape", "ring", "area")))
    covers = pairs.where("larger").join(shapes.select(F.col("shape").alias("j_shape"), "last_ord"), "j_shape")
    after = covers.groupBy(F.col("i_shape").alias("shape")).agg(F.max("last_ord").alias("after"))
    open_members = keyed.join(after, "shape", "left").where(F.col("after").isNull() | (F.col("ord") > F.col("after")))
    candidates = open_members.groupBy("shape").agg(F.min(F.struct("ord", "osm_id")).alias("c"))
    candidates = cut_lineage(candidates.select("shape", "c.ord", "c.osm_id"))
    i = candidates.select(F.col("shape").alias("i_shape"), F.col("ord").alias("i_ord"))
    j = candidates.select(F.col("shape").alias("j_shape"), F.col("ord").alias("j_ord"))
    blocked = pairs.join(i, "i_shape").join(j, "j_shape").where("j_ord < i_ord")
    gone = spatial.ordered_drops(blocked, "i_ord", "j_ord").withColumnRenamed("i_ord", "ord")
    kept = candidates.join(gone, "ord", "left_anti").select("osm_id")
    return keyed.select("osm_id").join(kept, "osm_id", "left_anti")


def drop_enclosed(items: DataFrame) -> DataFrame:
    return items.join(enclosed_ids(items), "osm_id", "left_anti")


def build(ways: DataFrame, scale: float = 1.0) -> DataFrame:
    """All kept buildings of a way table: ``(osm_id, ord, tags, ring, area, height_m)``."""
    segments = carriageway_segments(ways.where(tags.highway() != ""), scale)
    return drop_enclosed(cut_lineage(footprints_after_roads(ways, segments)))


def with_lod_cell(items: DataFrame, size: float = K.LOD0_CELL_M) -> DataFrame:
    """Add the level-of-detail cell of the area centroid and its token."""
    center = items.withColumn("_c", lines.ring_centroid(F.col("ring")))
    cells = center.withColumn("ix", tags.cell(F.col("_c.x"), size)).withColumn("iy", tags.cell(F.col("_c.y"), size))
    return cells.withColumn("cell", tags.cell_token(F.col("ix"), F.col("iy"))).drop("_c")


def lod_groups(items: DataFrame, size: float = K.LOD0_CELL_M) -> DataFrame:
    """Buildings per cell, with the cell's bounding box and greatest height."""
    b = lines.bounds(F.col("ring"))
    return (
        with_lod_cell(items, size)
        .withColumn("b", b)
        .groupBy("ix", "iy", "cell")
        .agg(
            F.count("*").alias("n"),
            F.min("b.x0").alias("x0"), F.min("b.y0").alias("y0"), F.max("b.x1").alias("x1"), F.max("b.y1").alias("y1"),
            F.max("height_m").alias("height_m"),
        )
    )


def facade_groups(items: DataFrame, size: float = K.LOD0_CELL_M) -> DataFrame:
    """Buildings per (cell, band, facade variant)."""
    band = tags.facade_band(F.col("height_m"))
    grouped = with_lod_cell(items, size).withColumn("band", band)
    grouped = grouped.withColumn("variant", tags.facade_variant(F.col("osm_id"), F.col("band")))
    return grouped.groupBy("cell", "band", "variant").agg(F.count("*").alias("n"))


def simple_footprints(ways: DataFrame) -> DataFrame:
    """Every closed building ring, without the road and enclosure tests."""
    return footprints(ways)
