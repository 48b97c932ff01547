"""The road network: node degrees, chains of one road, pavement polygons, rank order of overlaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.functions import kernel, lines, tags
from urbanweave.operators import ribbons, spatial
from urbanweave.operators.buildings import _boxed
from urbanweave.session import cut_lineage

ROAD_CELL_M = 100.0


def node_degree(ways: DataFrame) -> DataFrame:
    """Incident segments per millimetre node: ``(nx, ny, degree)``; zero-length segments do not count."""
    segs = ways.select(F.explode(lines.segments(F.col("coords"))).alias("s")).where(F.col("s").isNotNull())
    keyed = segs.select(
        F.array(
            F.struct(tags.node_mm(F.col("s.x0")).alias("nx"), tags.node_mm(F.col("s.y0")).alias("ny")),
            F.struct(tags.node_mm(F.col("s.x1")).alias("nx"), tags.node_mm(F.col("s.y1")).alias("ny")),
        ).alias("ends")
    )
    ends = keyed.where(F.col("ends")[0] != F.col("ends")[1]).select(F.inline("ends"))
    return ends.groupBy("nx", "ny").agg(F.count("*").alias("degree"))


def way_vertices(ways: DataFrame, *columns: str) -> DataFrame:
    """One row per vertex with position, neighbours and node key."""
    at = lambda c, i: F.get(c, i)
    rows = ways.select(
        *columns, "coords", F.posexplode("coords").alias("pos", "p"), F.size("coords").alias("n_vertices")
    )
    rows = rows.withColumn("before", F.when(F.col("pos") > 0, at(F.col("coords"), F.col("pos") - 1)))
    rows = rows.withColumn("after", at(F.col("coords"), F.col("pos") + 1)).drop("coords")
    return rows.withColumn("nx", tags.node_mm(F.col("p.x"))).withColumn("ny", tags.node_mm(F.col("p.y")))


# ---- chains of one road


def _chain_ends(ways: DataFrame) -> DataFrame:
    """Both ends of the open ways that may be chained, with node, outbound heading, rank and tags."""
    fit = ways.where(~F.col("closed") & tags.is_bufferable() & ~tags.is_roundabout())
    c = F.col("coords")

    def an_end(side: int, point: Column, heading: Column) -> Column:
        return F.struct(
            F.lit(side).alias("side"), tags.node_mm(point["x"]).alias("nx"), tags.node_mm(point["y"]).alias("ny"),
            heading.alias("heading"),
        )

    both = F.array(an_end(0, lines.first(c), lines.start_heading(c)), an_end(1, lines.last(c), lines.end_heading(c)))
    ends = fit.select("ord", "tags", tags.road_rank().alias("rank"), F.inline(both))
    # a way that starts and ends at one node takes part there once, by its start
    once = Window.partitionBy("ord", "nx", "ny").orderBy("side")
    return ends.withColumn("nth", F.row_number().over(once)).where("nth = 1").drop("nth")


def chain_links(ways: DataFrame, degree: DataFrame) -> DataFrame:
    """Pairs of way ends that are one road passing a node: ``(a, a_side, b, b_side)`` by file order.

    At each node, in file order, an unused way pairs with the first later unused way of the same name, or of the
    same rank in the opposite direction. Nodes without such a pair link the only two arms of the best rank, or the
    only two arms when the node has no other segment.
    """
    ends = cut_lineage(_chain_ends(ways))
    a = ends.select("nx", "ny", *[F.col(c).alias(f"a_{c}") for c in ("ord", "side", "tags", "rank", "heading")])
    b = ends.select("nx", "ny", *[F.col(c).alias(f"b_{c}") for c in ("ord", "side", "tags", "rank", "heading")])
    named = tags.same_named_road("a_tags", "b_tags")
    opposed = (F.col("a_rank") == F.col("b_rank")) & lines.opposite(F.col("a_heading"), F.col("b_heading"))
    open_pairs = cut_lineage(
        a.join(b, ["nx", "ny"])
        .where((F.col("a_ord") < F.col("b_ord")) & tags.same_chain_class("a_tags", "b_tags") & (named | opposed))
        .select("nx", "ny", "a_ord", "a_side", "b_ord", "b_side")
    )
    # A pair is taken when it is the first of both its ends among the pairs still open; taken ends close others.
    links = None
    while not open_pairs.isEmpty():
        pair = F.struct("a_ord", "b_ord")
        ends_of = F.explode(F.array("a_ord", "b_ord"))
        first_pair = (
            open_pairs.select("nx", "ny", pair.alias("pair"), ends_of.alias("end"))
            .groupBy("nx", "ny", "end")
            .agg(F.min("pair").alias("pair"))
        )
        chosen = first_pair.groupBy("nx", "ny", "pair").count().where("count = 2").drop("count")
        taken = cut_lineage(
            open_pairs.withColumn("pair", pair).join(chosen, ["nx", "ny", "pair"], "left_semi").drop("pair")
        )
        links = taken if links is None else links.unionByName(taken)
        used = taken.select("nx", "ny", F.explode(F.array("a_ord", "b_ord")).alias("end"))
        for side in ("a_ord", "b_ord"):
            open_pairs = open_pairs.join(used.withColumnRenamed("end", side), ["nx", "ny", side], "left_anti")
        open_pairs = cut_lineage(open_pairs.select("nx", "ny", "a_ord", "a_side", "b_ord", "b_side"))
    paired = (links if links is not None else open_pairs).select("nx", "ny").distinct()
    rest = ends.join(paired, ["nx", "ny"], "left_anti")
    per_rank = rest.groupBy("nx", "ny", "rank").agg(F.count("*").alias("n"))
    per_node = per_rank.groupBy("nx", "ny").agg(
        F.sum("n").alias("arms"), F.min("rank").alias("best"), F.min_by("n", "rank").alias("n_top")
    )
    rest = rest.join(per_node, ["nx", "ny"]).join(degree, ["nx", "ny"], "left")
    bend = (F.col("n_top") == 2) & (F.col("rank") == F.col("best"))
    plain = (F.col("n_top") != 2) & (F.col("arms") == 2) & (F.col("degree") == 2)
    two = _first_and_last(rest.where(bend | plain))
    two = two.where(tags.same_chain_class("a_tags", "b_tags")).select("nx", "ny", "a_ord", "a_side", "b_ord", "b_side")
    return two if links is None else links.unionByName(two)


def _first_and_last(ends: DataFrame) -> DataFrame:
    """The two ends of every node as one row (the caller leaves exactly two per node)."""
    value = F.struct("side", "tags")
    return ends.groupBy("nx", "ny").agg(
        F.min("ord").alias("a_ord"), F.max("ord").alias("b_ord"),
        F.min_by(value, "ord").alias("a"), F.max_by(value, "ord").alias("b"),
    ).select(
        "nx", "ny", "a_ord", "b_ord", F.col("a.side").alias("a_side"), F.col("b.side").alias("b_side"),
        F.col("a.tags").alias("a_tags"), F.col("b.tags").alias("b_tags"),
    )


def merge_chains(ways: DataFrame, degree: DataFrame) -> DataFrame:
    """Ways with linked ends joined to one line each: ``(osm_id, ord, tags, coords, closed, widths)``.

    Every way is seen in both directions; a link leads from the far end of one directed way to the next. The place
    in the chain is found by pointer doubling, in as many rounds as the logarithm of the longest chain, so a chain
    of any length is spread over the cluster. The id and tags are the longest way's.
    """
    links = cut_lineage(chain_links(ways, degree))
    plain = ways.withColumn("widths", F.array_repeat(tags.road_width(), F.size("coords")))
    if links.isEmpty():
        return plain.select("osm_id", "ord", "tags", "coords", "closed", "widths")
    parts = cut_lineage(spatial.components(links, "a_ord", "b_ord"))
    # a directed way (ord, side it starts from) leaves by its other end
    step = links.select(
        F.inline(
            F.array(
                F.struct(F.col("a_ord").alias("ord"), (1 - F.col("a_side")).alias("entry"),
                         F.col("b_ord").alias("next_ord"), F.col("b_side").alias("next_entry")),
                F.struct(F.col("b_ord").alias("ord"), (1 - F.col("b_side")).alias("entry"),
                         F.col("a_ord").alias("next_ord"), F.col("a_side").alias("next_entry")),
            )
        )
    )
    nodes = parts.withColumnRenamed("node", "ord")
    directed = nodes.withColumn("entry", F.explode(F.array(F.lit(0), F.lit(1))))
    linked = directed.join(step, ["ord", "entry"], "left")
    # a ring has no free end: cut it before its first way
    free = linked.groupBy("component").agg(F.count(F.when(F.col("next_ord").isNull(), 1)).alias("free"))
    linked = linked.join(free, "component")
    into_first = (F.col("free") == 0) & (F.col("next_ord") == F.col("component")) & (F.col("next_entry") == 0)
    out_of_first = (F.col("free") == 0) & (F.col("ord") == F.col("component")) & (F.col("entry") == 1)
    cut = into_first | out_of_first
    linked = linked.withColumn("next_ord", F.when(~cut, F.col("next_ord"))).withColumn(
        "next_entry", F.when(~cut, F.col("next_entry"))
    )
    here = linked.select(
        "component", "ord", "entry", F.when(F.col("next_ord").isNull(), 0).otherwise(1).alias("hops"),
        F.coalesce("next_ord", "ord").alias("to_ord"), F.coalesce("next_entry", "entry").alias("to_entry"),
    )
    here = cut_lineage(here)
    while True:
        ahead = here.select(
            F.col("ord").alias("to_ord"), F.col("entry").alias("to_entry"), F.col("hops").alias("more"),
            F.col("to_ord").alias("far_ord"), F.col("to_entry").alias("far_entry"),
        )
        nxt = here.join(ahead, ["to_ord", "to_entry"]).select(
            "component", "ord", "entry", (F.col("hops") + F.col("more")).alias("hops"),
            F.col("far_ord").alias("to_ord"), F.col("far_entry").alias("to_entry"),
        )
        nxt = cut_lineage(nxt)
        if nxt.agg(F.sum("hops")).first()[0] == here.agg(F.sum("hops")).first()[0]:
            break
        here = nxt
    # of the two opposite runs keep the one that begins at the end seen first in file order
    head = here.groupBy("component").agg(F.max("hops").alias("top"))
    heads = here.join(head, "component").where("hops = top").groupBy("component").agg(
        F.min(F.struct("ord", "entry")).alias("h"), F.max("top").alias("top")
    )
    target = here.join(heads, "component").where((F.col("ord") == F.col("h.ord")) & (F.col("entry") == F.col("h.entry")))
    target = target.select("component", "to_ord", "to_entry", "top")
    run = here.join(target, ["component", "to_ord", "to_entry"]).select(
        "component", "ord", "entry", (F.col("top") - F.col("hops")).alias("place")
    )
    ways_in = run.join(ways, "ord")
    oriented = F.when(F.col("entry") == 0, F.col("coords")).otherwise(F.reverse("coords"))
    body = ways_in.select(
        "component", "ord", "place", "osm_id", "tags", lines.length(F.col("coords")).alias("len"),
        tags.road_width().alias("width"), oriented.alias("coords"),
    )
    tail = F.when(F.col("place") == 0, F.col("coords")).otherwise(F.slice("coords", F.lit(2), F.size("coords")))
    piece = F.struct(
        "place", tail.alias("coords"), F.array_repeat("width", F.size(tail)).alias("widths")
    )
    merged = body.groupBy("component").agg(
        F.array_sort(F.collect_list(piece)).alias("pieces"),
        F.max_by(F.struct("osm_id", "tags"), F.struct("len", (-F.col("ord")).alias("o"))).alias("longest"),
    )
    joined = merged.select(
        F.col("longest.osm_id").alias("osm_id"), F.col("component").alias("ord"), F.col("longest.tags").alias("tags"),
        F.flatten(F.transform("pieces", lambda p: p["coords"])).alias("coords"),
        F.flatten(F.transform("pieces", lambda p: p["widths"])).alias("widths"),
    )
    closed = (F.size("coords") >= 4) & lines.same_node(lines.first(F.col("coords")), lines.last(F.col("coords")))
    joined = joined.withColumn("closed", closed)
    single = plain.join(nodes.select("ord"), "ord", "left_anti")
    columns = ["osm_id", "ord", "tags", "coords", "closed", "widths"]
    return single.select(*columns).unionByName(joined.select(*columns))


# ---- pavement


def pavement(ways: DataFrame) -> DataFrame:
    """Pavement of highway ways: merged chains with rounded bends as convex ``parts``."""
    usable = ways.where(tags.is_bufferable())
    merged = merge_chains(usable, node_degree(ways))
    chains = cut_lineage(merged.where(lines.length(F.col("coords")) > 0))
    return ribbons.paved(chains, ribbons.smooth_vertices(chains))


def rank_order(ways: DataFrame) -> Column:
    """Total order in which roads keep an overlap: class rank, then id, then file order."""
    return F.struct(tags.road_rank().alias("rank"), F.col("osm_id"), F.col("ord"))


def cut_by_rank(roads: DataFrame, key: str = "ord") -> DataFrame:
    """Remove from every road the area of the roads before it in rank order.

    Works on single convex parts: each part meets only the parts in its grid cells, copies of one cutter outline are
    merged first, and the pieces left of a road are collected again at the end.
    """
    pieces = roads.select(key, rank_order(roads).alias("rank"), F.posexplode("parts").alias("part_no", "part"))
    boxed = cut_lineage(_boxed(pieces, lines.bounds(F.col("part"))))
    corners = ["x0", "y0", "x1", "y1"]
    left = boxed.select(F.col(key).alias("l_key"), F.col("rank").alias("l_rank"), "part_no", *corners)
    right = boxed.select(F.col(key).alias("r_key"), F.col("rank").alias("r_rank"), F.col("part").alias("r_part"), *corners)

    def loses(l, r) -> Column:
        return (r("r_rank") < l("l_rank")) & (l("l_key") != r("r_key"))

    pairs = spatial.box_join(left, right, ROAD_CELL_M, condition=loses)
    cutters = pairs.select("l_key", "part_no", "r_part").distinct()
    grouped = cutters.groupBy("l_key", "part_no").agg(F.collect_list("r_part").alias("cutters"))
    hit = pieces.join(grouped, (F.col(key) == F.col("l_key")) & (pieces["part_no"] == grouped["part_no"]), "left")
    uncut = hit.where(F.col("cutters").isNull()).select(key, F.array("part").alias("left"))
    cut = kernel.add(hit.where(F.col("cutters").isNotNull()), "left", kernel.difference, F.array("part"), "cutters")
    cut = cut.select(key, "left")
    remains = uncut.unionByName(cut).groupBy(key).agg(F.flatten(F.collect_list("left")).alias("parts"))
    return roads.drop("parts").join(remains, key)


def motor_buffers(ways: DataFrame, cap: str = "round", scale: float = 1.0) -> DataFrame:
    """Half-width buffers of the motor roads as convex parts (which may overlap inside a way)."""
    motor = ways.where(tags.is_motor() & (F.size("coords") >= 2))
    simple = motor.withColumn("coords", lines.merge_straight(F.col("coords"))).where(lines.length(F.col("coords")) > 0)
    half = tags.road_width(scale=scale) / 2
    return simple.withColumn("parts", lines.buffer_parts(F.col("coords"), half, cap))


def motor_strips(ways: DataFrame, scale: float = 1.0) -> DataFrame:
    """Flat-ended boxes along the straight runs of the motor roads, one row per run: ``(osm_id, ord, tags, run, parts)``."""
    motor = ways.where(tags.is_motor() & (F.size("coords") >= 2))
    simple = motor.withColumn("coords", lines.merge_straight(F.col("coords")))
    boxes = lines.segment_boxes(F.col("coords"), tags.road_width(scale=scale) / 2)
    runs = simple.select("osm_id", "ord", "tags", F.posexplode(boxes).alias("run", "ring"))
    return runs.select("osm_id", "ord", "tags", "run", F.array("ring").alias("parts"))
