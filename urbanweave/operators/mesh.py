"""Triangles, walls and texture coordinates as tables, grouped by grid cell."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import kernel, lines, tags


@F.arrow_udf(lines.PARTS)
def fan_triangles(parts: pa.Array) -> pa.Array:
    """Triangles of convex parts, three points each."""
    return kernel.packed(([t for ring in rings for t in kernel.triangles([ring])] for rings in kernel.each_region(parts)), closed=False)


@F.arrow_udf(lines.PARTS)
def region_parts(outline: pa.Array, holes: pa.Array) -> pa.Array:
    """Convex parts of an outline with holes."""
    rows = zip(outline.to_pylist(), holes.to_pylist())
    cut = [kernel.convex_parts([kernel.to_ring(ring), *kernel.rings_of(inner or [])]) for ring, inner in rows]
    return pa.array([kernel.points_of(rings) for rings in cut], kernel.PARTS_ARROW)


def triangulate(shapes: DataFrame, min_area: float = 0.05) -> DataFrame:
    """Triangles of convex ``parts``: the other columns with ``tri`` and three points ``t``; tiny shapes drop out."""
    sized = shapes.where(kernel.parts_area(F.col("parts")) >= min_area)
    others = [c for c in shapes.columns if c != "parts"]
    cut = kernel.add(sized, "_t", fan_triangles, "parts")
    return cut.select(*others, F.posexplode("_t").alias("tri", "t"))


def flat_mesh(shapes: DataFrame, z_m: float) -> DataFrame:
    """Triangle corners in centimetres with planar texture coordinates, in the 400 m cell of the shape's middle."""
    rows = triangulate(shapes).select("*", F.posexplode("t").alias("corner", "p")).drop("t")
    x, y = F.col("p.x") * 100.0, F.col("p.y") * 100.0
    return rows.select(
        "*", x.alias("x_cm"), y.alias("y_cm"), F.lit(z_m * 100.0).alias("z_cm"), (x / K.FLAT_TILE_CM).alias("u"),
        (y / K.FLAT_TILE_CM).alias("v"),
    ).drop("p")


def parts_cell(shapes: DataFrame, size: float = K.LOD0_CELL_M) -> DataFrame:
    """Add the grid cell of the area centroid of disjoint convex parts."""
    center = F.aggregate(
        "parts", F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")),
        lambda acc, r: lines.let(
            F.struct(lines.ring_area(r).alias("a"), lines.ring_centroid(r).alias("c")),
            lambda v: F.struct(
                (acc["a"] + v["a"]).alias("a"), (acc["x"] + v["a"] * v["c"]["x"]).alias("x"),
                (acc["y"] + v["a"] * v["c"]["y"]).alias("y"),
            ),
        ),
    )
    rows = lines.finished(lines.finished(shapes, "parts").withColumn("_c", center), "_c").where("_c.a > 0")
    # to the micrometre, so that shapes centred on a cell's edge do not depend on the last bits of a sum
    cx, cy = F.round(F.col("_c.x") / F.col("_c.a"), 6), F.round(F.col("_c.y") / F.col("_c.a"), 6)
    return rows.withColumn("cell", tags.cell_token(tags.cell(cx, size), tags.cell(cy, size))).drop("_c")


def road_buckets(roads: DataFrame) -> DataFrame:
    """Pavement pieces and area per (surface, cell, height)."""
    z = F.round(K.LAYER_Z_M["roads"] + tags.road_elevation(), 3)
    pieces = roads.select(tags.road_surface().alias("surface"), z.alias("z_m"), F.explode("parts").alias("p"))
    celled = parts_cell(pieces.select("surface", "z_m", F.array("p").alias("parts")))
    return celled.groupBy("surface", "cell", "z_m").agg(
        F.count("*").alias("n"), F.sum(kernel.parts_area(F.col("parts"))).alias("area")
    )


def marking_buckets(strips: DataFrame, zebra: DataFrame | None = None) -> DataFrame:
    """Paint pieces and area per (yellow or white, cell), zebra stripes among the white."""
    color = F.when(F.col("style").contains("yellow"), "y").otherwise("w")
    rows = strips.select(color.alias("color"), "parts")
    if zebra is not None:
        rows = rows.unionByName(zebra.select(F.lit("w").alias("color"), F.array("ring").alias("parts")))
    return parts_cell(rows).groupBy("color", "cell").agg(
        F.count("*").alias("n"), F.sum(kernel.parts_area(F.col("parts"))).alias("area")
    )


def wall_segments(items: DataFrame, key: str = "osm_id") -> DataFrame:
    """Outer walls with straight neighbours merged: ``(key, wall, x0, y0, x1, y1)`` in ring order.

    An edge starts a new wall where it leaves the direction of the wall's first edge; walls under 5 cm drop out.
    """
    rows = items.select(key, F.col("ring")).withColumn("walls", _merged_walls("ring"))
    out = rows.select(key, F.posexplode("walls").alias("wall", "w"))
    return out.select(key, "wall", "w.x0", "w.y0", "w.x1", "w.y1")


def _merged_walls(ring: str) -> Column:
    edges = F.filter(lines.segments(F.col(ring)), lambda s: s["len"] >= 1e-9)
    wall = "struct<x0:double,y0:double,x1:double,y1:double,ux:double,uy:double>"

    def add(acc: Column, s: Column) -> Column:
        ux, uy = (s["x1"] - s["x0"]) / s["len"], (s["y1"] - s["y0"]) / s["len"]
        open_wall = F.element_at(acc, -1)
        same = (F.abs(open_wall["ux"] * uy - open_wall["uy"] * ux) < 0.02) & (open_wall["ux"] * ux + open_wall["uy"] * uy > 0.99)
        begun = F.struct(s["x0"].alias("x0"), s["y0"].alias("y0"), s["x1"].alias("x1"), s["y1"].alias("y1"), ux.alias("ux"), uy.alias("uy"))
        grown = F.struct(
            open_wall["x0"].alias("x0"), open_wall["y0"].alias("y0"), s["x1"].alias("x1"), s["y1"].alias("y1"),
            open_wall["ux"].alias("ux"), open_wall["uy"].alias("uy"),
        )
        longer = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(grown))
        return F.when((F.size(acc) > 0) & same, longer).otherwise(F.concat(acc, F.array(begun)))

    walls = F.aggregate(edges, F.array().cast(f"array<{wall}>"), add)
    return F.filter(walls, lambda w: lines.hypot(w["x1"] - w["x0"], w["y1"] - w["y0"]) >= 0.05)


def wall_quads(items: DataFrame) -> DataFrame:
    """Walls of buildings with heights and texture coordinates: u follows the perimeter, v the height.

    Needs ``osm_id, ring, height_m, tags``; ``uv_mode`` is optional (``tile`` when missing).
    """
    band = tags.facade_band(F.col("height_m"))
    described = items.withColumn("band", band).withColumn("floors", tags.tile_floors(F.col("band")))
    mode = F.col("uv_mode") if "uv_mode" in items.columns else F.lit("tile")
    sheet = mode == "unique_sheet"
    storey = F.col("floors") * (K.FLOOR_HEIGHT_M * 100.0)
    u_cm = F.when(sheet, F.greatest(F.lit(4.0), tags.sheet_width(F.col("band"))) * 100.0).otherwise(
        F.lit(K.FACADE_TILE_U_CM * K.FACADE_TILE_UV_SCALE)
    )
    v_cm = F.when(sheet, storey).otherwise(storey * K.FACADE_TILE_UV_SCALE)
    meta = described.select(F.col("osm_id").alias("b_id"), "height_m", u_cm.alias("u_cm"), v_cm.alias("v_cm"), "ring")
    # the estimated size of the descriptions is far below the real one; without the hint they go through the driver
    walls = wall_segments(meta, "b_id").join(meta.drop("ring").hint("merge"), "b_id")
    size = lines.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) * 100.0
    walls = walls.withColumn("len_cm", size)
    run = Window.partitionBy("b_id").orderBy("wall").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("len_cm").over(run)
    z0 = K.LAYER_Z_M["buildings"] * 100.0
    return walls.withColumn("s1", end).select(
        F.col("b_id").alias("osm_id"), "wall", *[(F.col(c) * 100.0).alias(f"{c}_cm") for c in ("x0", "y0", "x1", "y1")],
        F.lit(z0).alias("z0_cm"), (z0 + F.col("height_m") * 100.0).alias("z1_cm"),
        ((F.col("s1") - F.col("len_cm")) / F.col("u_cm")).alias("u0"), (F.col("s1") / F.col("u_cm")).alias("u1"),
        (F.col("height_m") * 100.0 / F.col("v_cm")).alias("v1"),
    )


def point_offsets(meshes: DataFrame, group: list[str], order: str, points: str, faces: str) -> DataFrame:
    """First point and face number of each mesh inside its merged group."""
    run = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return meshes.withColumn("point_offset", F.coalesce(F.sum(points).over(run), F.lit(0))).withColumn(
        "face_offset", F.coalesce(F.sum(faces).over(run), F.lit(0))
    )


def planar_uvs(points: DataFrame, mesh: str) -> DataFrame:
    """Texture coordinates on the two axes a mesh spans most, from 0 to 1: adds ``u, v``."""
    spans = points.groupBy(mesh).agg(*[f(c).alias(f"{n}_{c}") for c in "xyz" for f, n in ((F.min, "lo"), (F.max, "hi"))])
    # widest first; equal widths keep the order x, y, z
    ranked = F.array_sort(F.array(*[
        F.struct((F.col(f"lo_{c}") - F.col(f"hi_{c}")).alias("neg"), F.lit(i).alias("axis"), F.col(f"lo_{c}").alias("lo"))
        for i, c in enumerate("xyz")
    ]))
    joined = points.join(spans.select(mesh, ranked.alias("axes")), mesh)
    xyz = F.array("x", "y", "z")

    def along(k: int) -> Column:
        a = F.col("axes")[k]
        span = F.when(a["neg"] == 0, F.lit(1.0)).otherwise(-a["neg"])
        return (F.get(xyz, a["axis"]) - a["lo"]) / span

    return joined.withColumn("u", along(0)).withColumn("v", along(1)).drop("axes")


def union_footprints(items: DataFrame, size: float) -> DataFrame:
    """One mass per cell: the footprints' union as disjoint parts, with the greatest height.

    Copies of an outline are merged before a cell is gathered, so a cell holds different outlines only.
    """
    from urbanweave.operators import buildings, overlay

    celled = overlay.ring_to_parts(buildings.with_lod_cell(items, size))
    once = celled.groupBy("cell", "parts").agg(F.max("height_m").alias("height_m"))
    cells = once.groupBy("cell").agg(F.flatten(F.collect_list("parts")).alias("_all"), F.max("height_m").alias("height_m"))
    # most cells hold one convex outline, which is its own union if it runs counter-clockwise
    a, b, c = (F.get(F.get("_all", F.lit(0)), F.lit(i)) for i in range(3))
    turn = (b["x"] - a["x"]) * (c["y"] - b["y"]) - (b["y"] - a["y"]) * (c["x"] - b["x"])
    many = (F.size("_all") > 1) | ~F.coalesce(turn > 0, F.lit(False))
    merged = kernel.add(cells, "_union", kernel.disjoint_parts, F.when(many, F.col("_all")).otherwise(kernel.none_of("_all")))
    return merged.select("cell", F.when(many, F.col("_union")).otherwise(F.col("_all")).alias("parts"), "height_m")
