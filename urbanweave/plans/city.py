"""Whole jobs over a way and a node table: city layers, feature catalogue, navigation raster.

The layers share their inputs lazily; each stage that several layers read is cut once with a checkpoint, and one
action per sink runs the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import tags
from urbanweave.operators import buildings, junctions, markings, osm, overlay, placement, raster, roads
from urbanweave.session import cut_lineage
from urbanweave.sources import catalog


def build(ways: DataFrame, nodes: DataFrame) -> dict[str, DataFrame]:
    """Every city layer by name; water and vegetation are cut by all buildings that touch them."""
    highways = cut_lineage(ways.where(tags.highway() != ""))
    degree = cut_lineage(roads.node_degree(highways))
    pavement = cut_lineage(roads.cut_by_rank(cut_lineage(roads.pavement(highways))))
    crossings = cut_lineage(junctions.typed_junctions(highways, degree))
    houses = cut_lineage(buildings.build(ways))
    cutters = overlay.ring_to_parts(houses).select("osm_id", "parts")
    return {
        "roads": pavement,
        "junctions": crossings,
        "zebra": junctions.zebra_stripes(crossings),
        "markings": markings.road_markings(pavement, degree),
        "arrows": junctions.junction_arrows(pavement, degree, crossings),
        "buildings": houses,
        "water": overlay.cut_by(overlay.water_areas(ways), cutters),
        "vegetation": overlay.cut_by(overlay.vegetation_areas(ways), cutters),
        "trees": placement.tree_instances(nodes),
        "lamps": placement.lamp_instances(highways),
        "signs": placement.sign_placements(highways),
    }


def statistics(layers: dict[str, DataFrame]) -> DataFrame:
    return osm.layer_counts(**layers)


def write_catalog(ways: DataFrame, nodes: DataFrame, west: float, north: float, path: str, size: float = K.SHARD_CELL_M) -> DataFrame:
    """Write the sharded feature catalogue; returns its manifest."""
    features = osm.features(ways, nodes, west, north, size)
    catalog.write_shards(features, path)
    return osm.shard_manifest(features)


def navigation(ways: DataFrame, grid: raster.Grid, connected: bool = True, simple_buildings: bool = False) -> DataFrame:
    """Occupancy pixels of the navigation raster; the connected form frees every pixel a motor road touches."""
    occupied, free = overlay.nav_layers(ways, connected, simple_buildings)
    return raster.paint_occupancy(occupied, free, grid, free_all_touched=connected)


def planner_cost(occupancy: DataFrame, grid: raster.Grid, close_m: float, inflate_m: float, inscribed_m: float) -> DataFrame:
    """Local-planner cost of an occupancy raster (unpainted pixels count as occupied)."""
    px = raster.dense(occupancy.select("row", "col", "v"), grid.ny, grid.nx, v=K.OCCUPIED)
    return raster.mppi_cost(px, grid.ny, grid.nx, grid.res, close_m, inflate_m, inscribed_m)


def scaled_road_cost(occupancy: DataFrame, grid: raster.Grid, scale: float, inscribed_m: float) -> DataFrame:
    """Soft and binary cost of the roads widened by a factor."""
    px = raster.dense(occupancy.select("row", "col", "v"), grid.ny, grid.nx, v=K.OCCUPIED)
    wide = cut_lineage(raster.widen_corridors(px.select("row", "col", (F.col("v") == K.FREE).alias("free")), grid.nx, scale))
    soft = raster.soft_cost(wide, grid.nx, grid.res, inscribed_m)
    return soft.join(wide.select("row", "col", raster.binary_cost(F.col("free")).alias("binary")), ["row", "col"])
