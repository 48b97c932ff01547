"""A map file of either format to local ways and nodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.functions import frame
from urbanweave.operators import osm
from urbanweave.sources.osm_pbf import read_osm_pbf
from urbanweave.sources.osm_xml import read_osm_xml


def read_osm(spark: SparkSession, path: str, origin: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ways, tagged nodes and the one-row lon/lat box of a map file, in metres around ``origin``.

    Without an origin the box centre is used; only that one row comes to the driver.
    """
    read = read_osm_pbf if path.lower().endswith(".pbf") else read_osm_xml
    nodes, refs, way_tags = read(spark, path)
    box = osm.lonlat_bounds(nodes)
    if origin is None:
        o = box.first()["origin"]
        origin = frame.make_origin(o["lon"], o["lat"])
    local = osm.to_local(nodes, origin)
    ways = osm.assemble_ways(refs, local.select("node_id", "x", "y"), way_tags)
    tagged = osm.tagged_nodes(local).select(F.col("node_id").alias("osm_id"), F.col("node_id").alias("ord"), "tags", "x", "y")
    return ways, tagged, box
