"""Typed junctions, zebra stripes and approach arrows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import lines, tags
from urbanweave.operators import spatial
from urbanweave.operators.roads import way_vertices
from urbanweave.session import cut_lineage


def roundabout_patches(ways: DataFrame, primary_only: bool = False) -> DataFrame:
    """Area of roundabout ways as convex parts: ``(osm_id, parts, x, y)``."""
    rings = ways.where(tags.is_roundabout() & (F.size("coords") >= 3))
    if primary_only:
        rings = rings.where(tags.is_primary_junction())
    c, width = F.col("coords"), F.greatest(F.lit(5.0), tags.road_width())
    measured = rings.withColumn("len", lines.length(c)).withColumn("width", width)
    closed, total, w = F.col("closed"), F.col("len"), F.col("width")
    dot = F.array(lines.disc(lines.first(c), F.greatest(F.lit(6.0), w)))
    tiny = F.when(F.size(c) >= 4, F.array(c)).otherwise(F.array(lines.disc(lines.first(c), F.lit(8.0))))
    parts = (
        F.when(closed & (total < 8), tiny)
        .when(closed, lines.buffer_parts(c, w / 2 + 0.8))
        .when(total < 1.0, dot)
        .otherwise(lines.buffer_parts(c, w / 2 + 1.5))
    )
    center = lines.vertex_mean(F.when(closed, F.slice(c, F.lit(1), F.size(c) - 1)).otherwise(c))
    return measured.select("osm_id", parts.alias("parts"), center["x"].alias("x"), center["y"].alias("y"))


def node_arms(vertices: DataFrame) -> DataFrame:
    """Outbound headings of each way at each node, close ones merged: ``(nx, ny, ord, arms)``."""
    back = F.when(F.col("before").isNotNull(), lines.heading(F.col("p"), F.col("before")))
    ahead = F.when(F.col("after").isNotNull(), lines.heading(F.col("p"), F.col("after")))
    raw = F.array_compact(F.array(back, ahead))
    grouped = vertices.select("nx", "ny", "ord", "pos", raw.alias("raw")).groupBy("nx", "ny", "ord").agg(
        F.array_sort(F.collect_list(F.struct("pos", "raw"))).alias("raw")
    )
    arms = lines.cluster_headings(F.flatten(F.transform("raw", lambda r: r["raw"])))
    return grouped.select("nx", "ny", "ord", arms.alias("arms"))


def junction_candidates(ways: DataFrame, degree: DataFrame) -> DataFrame:
    """Way visits of junction nodes: degree of at least three, two ways, two of them primary, not on a roundabout.

    ``(nx, ny, ord, pos, osm_id, width, arms)``, one row per way at a node; ``pos`` is the way's first vertex there.
    """
    # the rules of the tags are judged once a way; no vertex carries the tags through a shuffle
    told = ways.where(F.size("coords") >= 2).select(
        "osm_id", "ord", "coords", tags.is_primary_junction().alias("primary"), tags.road_width().alias("width"),
        (tags.is_roundabout() & tags.is_primary_junction()).alias("ring"), (tags.is_motor() & ~tags.is_roundabout()).alias("motor"),
    )
    ring_nodes = way_vertices(told.where("ring")).select("nx", "ny").distinct()
    busy = degree.where("degree >= 3").select("nx", "ny")
    motor = way_vertices(told.where("motor"), "osm_id", "ord", "primary", "width").drop("n_vertices")
    at = cut_lineage(motor.join(busy, ["nx", "ny"]).join(ring_nodes, ["nx", "ny"], "left_anti"))
    visits = at.groupBy("nx", "ny", "ord").agg(
        F.first("osm_id").alias("osm_id"), F.first("primary").alias("primary"), F.first("width").alias("width"), F.min("pos").alias("pos"),
    )
    fit = visits.groupBy("nx", "ny").agg(F.count_distinct("osm_id").alias("n_ids"), F.count_if("primary").alias("n_primary"))
    fit = fit.where("n_ids >= 2 and n_primary >= 2").select("nx", "ny")
    rows = visits.join(fit, ["nx", "ny"]).join(node_arms(at), ["nx", "ny", "ord"])
    return rows.select("nx", "ny", "ord", "pos", "osm_id", "width", "arms")


def cluster_nodes(nodes: DataFrame, reach: float = K.JUNCTION_CLUSTER_M) -> DataFrame:
    """Group millimetre nodes ``(nx, ny)`` whose chain of distances never exceeds ``reach``: adds ``cluster``.

    Nodes inside one cell of a diagonal ``reach`` belong together without a test, so only the cell's first node stands
    for their links; pairs are built between neighbouring cells only.
    """
    side = reach * 1000 / math.sqrt(2) * (1 - 1e-9)
    keyed = nodes.select("nx", "ny", F.xxhash64("nx", "ny").alias("id")).withColumn("cx", F.floor(F.col("nx") / side))
    keyed = cut_lineage(keyed.withColumn("cy", F.floor(F.col("ny") / side)))
    heads = keyed.groupBy("cx", "cy").agg(F.min("id").alias("head"))
    inside = keyed.join(heads, ["cx", "cy"]).where("id <> head").select(F.col("id").alias("a"), F.col("head").alias("b"))
    around = F.array(*[
        F.struct((F.col("cx") + i).alias("cx"), (F.col("cy") + j).alias("cy"))
        for i in range(-2, 3) for j in range(-2, 3) if (i, j) > (0, 0)
    ])
    shifted = keyed.select(F.col("id").alias("a"), F.col("nx").alias("ax"), F.col("ny").alias("ay"), F.inline(around))
    near = shifted.join(keyed, ["cx", "cy"])
    dx, dy = F.col("nx") - F.col("ax"), F.col("ny") - F.col("ay")
    limit = int(reach * 1000) ** 2
    near = near.where(dx * dx + dy * dy <= limit).select("a", F.col("id").alias("b"))
    groups = spatial.components(inside.unionByName(near), "a", "b")
    joined = keyed.join(groups, keyed["id"] == groups["node"], "left")
    return joined.select("nx", "ny", F.coalesce("component", "id").alias("cluster"))


def typed_junctions(ways: DataFrame, degree: DataFrame) -> DataFrame:
    """tee, wye, cross and roundabout junctions: ``(cluster, kind, x, y, width, clip_r, arms, nodes, parts)``.

    The nodes of a cluster follow their first visit in way order, and so do the headings that arms are found from.
    Equal headings are merged before they are collected: a repeated heading never changes the arms found. ``parts`` is
    the patch that clips markings and arrows. A roundabout of the primary roads has its own area as patch, no arms, no
    nodes and a null width.
    """
    visits = cut_lineage(junction_candidates(ways, degree))
    seen = cut_lineage(visits.groupBy("nx", "ny").agg(F.min(F.struct("ord", "pos")).alias("visit")))
    clusters = cluster_nodes(seen).join(seen, ["nx", "ny"])
    placed = cut_lineage(visits.drop("pos").join(clusters, ["nx", "ny"]))
    nodes = placed.select("cluster", "nx", "ny", "visit").distinct()
    node = F.struct("visit", lines.pt(F.col("nx") / 1000, F.col("ny") / 1000).alias("p"))
    center = nodes.groupBy("cluster").agg(
        (F.avg("nx") / 1000).alias("x"), (F.avg("ny") / 1000).alias("y"), F.array_sort(F.collect_list(node)).alias("nodes"),
    ).withColumn("nodes", F.transform("nodes", lambda n: n["p"]))
    sizes = placed.groupBy("cluster").agg(F.count_distinct("ord").alias("n_ways"), F.max("width").alias("width"))
    raw = placed.select("cluster", "visit", "ord", F.posexplode("arms").alias("i", "arm"))
    place = F.struct("visit", "ord", "i")
    once = raw.groupBy("cluster", "arm").agg(F.min(place).alias("place"))
    arms = once.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("place", "arm"))).alias("raw"))
    arms = arms.select("cluster", lines.cluster_headings(F.transform("raw", lambda r: r["arm"])).alias("arms"))
    joined = center.join(sizes, "cluster").join(arms, "cluster").where("n_ways >= 2")
    typed = joined.withColumn("kind", lines.junction_kind(F.col("arms"))).where(F.col("kind").isin("tee", "wye", "cross"))
    clip = F.greatest(F.lit(4.0), F.col("width") / 2 + 0.8)
    typed = typed.withColumn("clip_r", clip)
    typed = typed.select(
        "cluster", "kind", "x", "y", "width", "clip_r", "arms", "nodes", patch_parts(F.col("nodes"), F.col("clip_r")).alias("parts"),
    )
    rings = roundabout_patches(ways, primary_only=True).select(
        F.xxhash64(F.lit("roundabout"), "osm_id").alias("cluster"), F.lit("roundabout").alias("kind"), "x", "y",
        F.lit(None).cast("double").alias("width"), F.lit(None).cast("double").alias("clip_r"),
        F.array().cast("array<double>").alias("arms"), F.array().cast("array<struct<x:double,y:double>>").alias("nodes"), "parts",
    )
    return typed.unionByName(rings)


def zebra_stripes(junctions: DataFrame) -> DataFrame:
    """Five crossing stripes per arm (only the stem of a tee, none at roundabouts): ``(cluster, arm, stripe, ring)``."""
    arms = F.col("arms")
    junctions = junctions.where("kind <> 'roundabout'")
    index = F.sequence(F.lit(0), F.size(arms) - 1)
    through = F.filter(
        index,
        lambda i: F.exists(index, lambda j: (i != j) & lines.opposite(F.get(arms, F.least(i, j)), F.get(arms, F.greatest(i, j)))),
    )
    inbound = F.when(F.col("kind") == "tee", F.array_except(index, through)).otherwise(index)
    rows = junctions.withColumn("arm", F.explode(inbound)).withColumn("h", F.get(arms, F.col("arm")))
    ux, uy = F.cos("h"), F.sin("h")
    reach = F.aggregate(
        "nodes", F.lit(0.0),
        lambda acc, n: F.greatest(acc, (n["x"] - F.col("x")) * ux + (n["y"] - F.col("y")) * uy),
    )
    rows = rows.withColumn("start", reach + F.col("width") / 2 + 1.2)
    rows = rows.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(K.STRIPES_PER_ARM - 1))))
    t = F.col("start") + F.col("stripe") * (K.STRIPE_M + K.STRIPE_GAP_M)
    cx, cy = F.col("x") + ux * t, F.col("y") + uy * t
    # thickness runs across the arm, the span along it
    a, b = F.lit(K.STRIPE_M / 2), F.greatest(F.lit(5.0), F.col("width") * 0.92) * 0.45

    def corner(i: int, j: int) -> Column:
        return lines.pt(cx - i * uy * a + j * ux * b, cy + i * ux * a + j * uy * b)

    ring = F.array(corner(1, 1), corner(-1, 1), corner(-1, -1), corner(1, -1), corner(1, 1))
    return rows.select("cluster", "arm", "stripe", cx.alias("x"), cy.alias("y"), ring.alias("ring"))


def patch_parts(nodes: Column, r: Column) -> Column:
    """The buffered convex hull of the nodes: discs on its corners, bars along its edges, and the hull itself."""

    def parts(ring: Column) -> Column:
        discs = F.transform(F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(1))), lambda n: lines.disc(n, r))
        hull = F.when(F.size(ring) >= 4, F.array(ring)).otherwise(F.array().cast("array<array<struct<x:double,y:double>>>"))
        return F.concat(discs, lines.segment_boxes(ring, r), hull)

    return lines.let(lines.convex_hull(nodes), parts)


# ---- arrows


def approach_arrows(ways: DataFrame, degree: DataFrame) -> DataFrame:
    """Inbound arrows of the major roads at nodes of degree three or more, before any thinning.

    ``(osm_id, ord, pos, step, x, y, yaw)``; the arrow stands back from the node along the way, right of travel.
    """
    c = F.col("coords")
    fit = ways.where(
        tags.is_major() & ~F.col("closed") & ~tags.is_roundabout() & (tags.highway() != "junction") & (F.size("coords") >= 2)
    )
    fit = fit.where(~lines.looks_like_ring(c, F.col("closed")))
    width = tags.road_width()
    fit = fit.withColumn("offset", tags.inbound_offset()).withColumn("marks", lines.stations(c))
    fit = fit.withColumn("setback", F.greatest(F.lit(K.ARROW_SETBACK_M), width * 0.55 + K.JUNCTION_EXTRA_M + 2.5))
    rows = fit.select("osm_id", "ord", "coords", "marks", "offset", "setback", F.posexplode("coords").alias("pos", "p"))
    rows = rows.withColumn("nx", tags.node_mm(F.col("p.x"))).withColumn("ny", tags.node_mm(F.col("p.y")))
    busy = rows.join(degree.where("degree >= 3").select("nx", "ny"), ["nx", "ny"])
    both = busy.withColumn("step", F.explode(F.array(F.lit(-1), F.lit(1))))
    here = F.get("marks", F.col("pos"))
    at = here + F.col("step") * F.col("setback")
    total = F.element_at("marks", -1)
    placed = both.withColumn("at", at).withColumn("total", total).where((F.col("at") >= 0) & (F.col("at") <= F.col("total")))
    # the segment walked last leads back to the node
    seg = F.when(
        F.col("step") > 0, F.size(F.filter("marks", lambda m: m < F.col("at"))) - 1
    ).otherwise(F.size(F.filter("marks", lambda m: m <= F.col("at"))) - 1)
    placed = placed.withColumn("seg", seg)
    a, b = F.get(c, F.col("seg")), F.get(c, F.col("seg") + 1)
    yaw = F.when(F.col("step") > 0, lines.heading(b, a)).otherwise(lines.heading(a, b))
    placed = placed.withColumn("yaw", yaw).withColumn("q", lines.point_at(c, F.col("at")))
    return placed.select(
        "osm_id", "ord", "pos", "step", (F.col("q.x") + F.sin("yaw") * F.col("offset")).alias("x"),
        (F.col("q.y") - F.cos("yaw") * F.col("offset")).alias("y"), "yaw",
    )


def first_per_spot(arrows: DataFrame) -> DataFrame:
    """One arrow per half-metre spot and hundredth of a radian, the first in way order."""
    key = [F.bround(F.col("x") * 2).cast("long"), F.bround(F.col("y") * 2).cast("long"), F.bround(F.col("yaw") * 100).cast("long")]
    order = F.struct("ord", "pos", "step")
    best = arrows.groupBy(*[k.alias(f"k{i}") for i, k in enumerate(key)]).agg(F.min_by(F.struct("*"), order).alias("r"))
    return best.select("r.*")


def thin_arrows(arrows: DataFrame, same_m: float = 14.0, cross_m: float = 4.2) -> DataFrame:
    """Drop arrows too near an earlier kept one: same heading within 14 m, crossing within 4.2 m."""
    order = F.struct("ord", "pos", "step")
    keyed = arrows.withColumn("id", order)
    box = lambda pad, side: keyed.select(
        F.col("id").alias(f"{side}_id"), F.col("x").alias(f"{side}_x"), F.col("y").alias(f"{side}_y"),
        F.col("yaw").alias(f"{side}_yaw"), (F.col("x") - pad).alias("x0"), (F.col("y") - pad).alias("y0"),
        (F.col("x") + pad).alias("x1"), (F.col("y") + pad).alias("y1"),
    )

    def earlier(l, r) -> Column:
        turn = lines.angle_abs(l("i_yaw") - r("j_yaw"))
        gap = lines.hypot(l("i_x") - r("j_x"), l("i_y") - r("j_y"))
        crossing = (turn > 0.55) & (turn < math.pi - 0.55)
        return (r("j_id") < l("i_id")) & (((turn < 0.35) & (gap < same_m)) | (crossing & (gap < cross_m)))

    pairs = spatial.box_join(box(same_m / 2, "i"), box(same_m / 2, "j"), 4 * same_m, condition=earlier)
    gone = spatial.ordered_drops(pairs, "i_id", "j_id")
    return keyed.join(gone, keyed["id"] == gone["i_id"], "left_anti").drop("id")


def outside_areas(points: DataFrame, areas: DataFrame, margin: float = 0.0) -> DataFrame:
    """Points ``x, y`` that no convex part of the areas holds (or, with a margin, comes nearer than).

    The points and the boxes of the parts are made once: the cells of the join would copy the rules behind every corner
    into each of its filters and sequences.
    """
    keyed = cut_lineage(points.withColumn("_id", F.struct("ord", "pos", "step")))
    left = keyed.select(
        F.col("_id").alias("p_id"), F.col("x").alias("px"), F.col("y").alias("py"),
        (F.col("x") - margin).alias("x0"), (F.col("y") - margin).alias("y0"),
        (F.col("x") + margin).alias("x1"), (F.col("y") + margin).alias("y1"),
    )
    part = lines.finished(areas.select("parts"), "parts").select(F.explode("parts").alias("part")).withColumn("b", lines.bounds(F.col("part")))
    right = cut_lineage(part.select("part", "b.x0", "b.y0", "b.x1", "b.y1"))
    inside = lines.point_in_ring(F.col("px"), F.col("py"), F.col("part"))
    near = F.array_min(
        F.transform(lines.segments(F.col("part")), lambda s: lines.point_segment_distance(F.col("px"), F.col("py"), s))
    )
    pairs = spatial.box_join(left, right, 100.0).where(F.when(inside, F.lit(True)).otherwise((near < margin) | (near <= 0)))
    held = pairs.select("p_id").distinct()
    return keyed.join(held, keyed["_id"] == held["p_id"], "left_anti").drop("_id")


def junction_arrows(ways: DataFrame, degree: DataFrame, junctions: DataFrame | None = None) -> DataFrame:
    """Arrows on the approaches, none on roundabouts, thinned, none inside junction patches."""
    arrows = outside_areas(approach_arrows(ways, degree), roundabout_patches(ways), 0.4)
    kept = thin_arrows(cut_lineage(first_per_spot(arrows)))
    return kept if junctions is None else outside_areas(kept, junctions)


def arrow_ring() -> Column:
    """Chevron of an arrow at ``x, y, yaw``: stem and head, tip ahead."""
    half, wing, stem = K.ARROW_LENGTH_M / 2, K.ARROW_WIDTH_M / 2, K.ARROW_WIDTH_M * 0.17
    neck = half - K.ARROW_LENGTH_M * 0.42
    outline = [(half, 0.0), (neck, -wing), (neck, -stem), (-half, -stem), (-half, stem), (neck, stem), (neck, wing), (half, 0.0)]
    ux, uy = F.cos("yaw"), F.sin("yaw")
    return F.array(*[lines.pt(F.col("x") + ux * u - uy * v, F.col("y") + uy * u + ux * v) for u, v in outline])
