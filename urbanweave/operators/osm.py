"""From raw map elements to ways, tagged nodes, boxes and catalogue features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import frame, lines, tags


def locate_refs(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Join way references ``(way_id, pos, ref)`` to node positions ``(node_id, x, y)``; unknown nodes drop out."""
    return refs.join(nodes, refs["ref"] == nodes["node_id"]).select("way_id", "pos", "x", "y")


def collect_lines(vertices: DataFrame) -> DataFrame:
    """Ordered coordinates per way. A way has at most 2000 vertices by the map format, so a row stays small."""
    grouped = vertices.groupBy("way_id").agg(F.array_sort(F.collect_list(F.struct("pos", "x", "y"))).alias("v"))
    return grouped.select("way_id", F.transform("v", lambda v: lines.pt(v["x"], v["y"])).alias("coords"))


def assemble_ways(refs: DataFrame, nodes: DataFrame, way_tags: DataFrame) -> DataFrame:
    """Ways ``(osm_id, ord, tags, coords, closed)``: tagged, with at least two known vertices.

    ``nodes`` holds local metres; ``way_tags`` is ``(way_id, tags)`` with an optional ``ord`` (the file order).
    """
    order = F.col("ord") if "ord" in way_tags.columns else F.col("way_id")
    tagged = way_tags.where(F.size("tags") > 0).select("way_id", order.alias("ord"), "tags")
    assembled = collect_lines(locate_refs(refs, nodes)).where(F.size("coords") >= 2).join(tagged, "way_id")
    return assembled.select(
        F.col("way_id").alias("osm_id"), "ord", "tags", "coords", lines.is_closed(F.col("coords")).alias("closed")
    )


def tagged_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.size("tags") > 0)


def lonlat_bounds(nodes: DataFrame) -> DataFrame:
    """One row with the bounding box of node positions ``(lon, lat)`` and its centre as the origin."""
    box = nodes.agg(
        F.min("lon").alias("west"), F.min("lat").alias("south"), F.max("lon").alias("east"), F.max("lat").alias("north")
    )
    if box.where(F.col("west").isNull()).count():
        raise ValueError("the map data contains no nodes")
    center = frame.make_origin((F.col("west") + F.col("east")) / 2, (F.col("south") + F.col("north")) / 2)
    return box.withColumn("origin", center)


def to_local(nodes: DataFrame, origin: Column) -> DataFrame:
    """Add local metres ``x, y`` to nodes with ``lon, lat``; ``origin`` is a literal struct."""
    local = frame.lonlat_to_local(F.col("lon"), F.col("lat"), origin)
    return nodes.withColumn("p", local).withColumn("x", F.col("p.x")).withColumn("y", F.col("p.y")).drop("p")


def features(ways: DataFrame, nodes: DataFrame, west: float, north: float, size: float = K.SHARD_CELL_M) -> DataFrame:
    """Catalogue features of tagged ways and nodes with their shard; class ``other`` is left out."""
    center = lines.vertex_mean(F.col("coords"))
    rows = ways.select("osm_id", F.lit("way").alias("osm_type"), "tags", center.alias("c")).unionByName(
        nodes.select("osm_id", F.lit("node").alias("osm_type"), "tags", lines.pt(F.col("x"), F.col("y")).alias("c"))
    )
    rows = rows.where(F.size("tags") > 0).withColumn("category", tags.category()).where("category <> 'other'")
    shard = tags.shard_id(F.col("c.x"), F.col("c.y"), F.lit(float(west)), F.lit(float(north)), size)
    return rows.select(
        "osm_id", "osm_type", "category", "tags", F.col("c.x").alias("x"), F.col("c.y").alias("y"),
        shard.alias("catalog_shard"),
    )


def shard_manifest(feature_rows: DataFrame) -> DataFrame:
    """Feature count per shard in shard order, with the total repeated."""
    counts = feature_rows.groupBy("catalog_shard").agg(F.count("*").alias("feature_count"))
    total = counts.agg(F.sum("feature_count").alias("total_count"))  # over the counts: the features are made once
    return counts.join(F.broadcast(total)).orderBy("catalog_shard")


def layer_counts(**layers: DataFrame) -> DataFrame:
    """Row count of every layer, as ``(layer, n)``."""
    rows = None
    for name, df in layers.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("layer"), "n")
        rows = one if rows is None else rows.unionByName(one)
    return rows
