"""Choice of a scene's inputs and of its extent, one row per scene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.functions import frame


def choose_inputs(files: DataFrame) -> DataFrame:
    """Map, elevation and imagery file of every scene from a listing ``(scene, path, length)``.

    Map files: the ``osm/`` folder before the root, ``.osm.pbf`` before ``.osm``, then by name. Elevation and imagery:
    the largest file of their folder, else of the root; the imagery is never the elevation file.
    """
    path, lower = F.col("path"), F.lower("path")
    in_root = ~path.contains("/")
    direct_osm = F.regexp_like(path, F.lit(r"^osm/[^/]+$"))
    osm_place = F.when(direct_osm, 0).when(in_root, 2)
    osm_kind = F.when(path.endswith(".osm.pbf"), 0).when(path.endswith(".osm"), 1)
    tiff = lower.rlike(r"\.tiff?$")
    image = lower.rlike(r"\.(tiff?|png)$")
    marked = files.select(
        "scene", "path", "length",
        (osm_place + osm_kind).alias("osm_rank"),
        F.when(tiff & path.startswith("dem/"), 0).when(tiff & in_root, 1).alias("dem_rank"),
        F.when(image & path.startswith("imagery/"), 0).when(image & in_root, 1).alias("image_rank"),
    )

    def best(rank: str) -> Column:
        """Smallest rank, then the largest file, then the first name."""
        return F.when(F.col(rank).isNotNull(), F.struct(F.col(rank).alias("r"), (-F.col("length")).alias("l"), "path"))

    osm = F.min(F.when(F.col("osm_rank").isNotNull(), F.struct(F.col("osm_rank").alias("r"), "path")))
    first = marked.groupBy("scene").agg(osm.alias("osm"), F.min(best("dem_rank")).alias("dem"))
    # the folder of the imagery is settled before the elevation file is taken out
    folder = marked.groupBy("scene").agg(F.min("image_rank").alias("image_rank"))
    images = marked.join(folder, ["scene", "image_rank"]).join(first.select("scene", "dem"), "scene")
    images = images.where(F.col("dem").isNull() | (F.col("path") != F.col("dem.path")))
    image = images.groupBy("scene").agg(F.min(best("image_rank")).alias("image"))
    return first.join(image, "scene", "left").select(
        "scene", F.col("osm.path").alias("osm"), F.col("dem.path").alias("dem"), F.col("image.path").alias("imagery")
    )


def raster_boxes(catalog: DataFrame) -> DataFrame:
    """Lon/lat boxes of UTM rasters ``(path, left, bottom, right, top, epsg)``."""
    box = frame.raster_bounds_lonlat(*[F.col(c) for c in ("left", "bottom", "right", "top", "epsg")])
    return catalog.withColumn("box", box)


def resolve_extent(scenes: DataFrame) -> DataFrame:
    """Final box of every scene with how it was found, warnings and errors.

    Needs ``scene``, the boxes ``osm_box, dem_box, ortho_box, explicit_box`` (null when missing), ``mode``, ``pad_deg``,
    ``on_disjoint``, ``on_partial`` and ``allow_disjoint``. Errors become a column and leave the box null.
    """
    osm, dem, ortho = F.col("osm_box"), F.col("dem_box"), F.col("ortho_box")
    mode = F.col("mode")
    common = frame.box_intersection(dem, ortho)
    both = dem.isNotNull() & ortho.isNotNull()
    scenes = scenes.withColumn("grid", F.when(both, common).otherwise(F.coalesce(dem, ortho)))
    grid = F.col("grid")
    explicit = mode == "explicit"
    apart_terrain = ~explicit & both & grid.isNull()
    lenient = (F.col("on_disjoint") != "fail") | F.col("allow_disjoint")
    auto = (mode == "auto") & osm.isNotNull() & grid.isNotNull()
    scenes = scenes.withColumn("relation", F.when(auto, frame.box_relation(osm, grid)))
    relation = F.col("relation")
    apart, partial = F.coalesce(relation == "disjoint", F.lit(False)), F.coalesce(relation == "partial_overlap", F.lit(False))
    nested = auto & ~apart & ~partial
    grid_smaller = frame.box_area(grid) <= frame.box_area(osm)
    terrain_strategy = (
        F.when(both & grid.isNotNull(), "intersection(dem,ortho)")
        .when(~both & dem.isNotNull(), "dem_bounds").when(~both & ortho.isNotNull(), "ortho_bounds").otherwise("explicit")
    )
    final = (
        F.when(explicit, F.col("explicit_box"))
        .when(mode == "osm_bbox", osm)
        .when(mode == "dem_bounds", grid)
        .when(apart, F.when(F.col("allow_disjoint"), osm))
        .when(partial, frame.box_intersection(osm, grid))
        .when(nested, F.when(grid_smaller, grid).otherwise(osm))
        .otherwise(F.coalesce(grid, osm))
    )
    strategy = (
        F.when(explicit, "explicit")
        .when(mode == "osm_bbox", "osm_bbox")
        .when(mode == "dem_bounds", terrain_strategy)
        .when(apart & F.col("allow_disjoint"), "osm_only_allow_disjoint")
        .when(partial, "intersection(osm,terrain)")
        .when(nested, F.when(grid_smaller, "min_area_grid").otherwise("min_area_osm"))
        .when((mode == "auto") & grid.isNull() & osm.isNotNull(), "osm_bbox")
        .otherwise(terrain_strategy)
    )
    label = frame.box_relation_label(osm, grid)
    held = relation == "containment"
    versus = (
        F.when(~auto, "n/a")
        .when(held & grid_smaller & frame.box_contains(osm, grid), "dem_contained_in_osm")
        .when(held & ~grid_smaller & frame.box_contains(grid, osm), "osm_contained_in_dem")
        .otherwise(label)
    )

    def note(when: Column, text: str) -> Column:
        return F.when(when, F.lit(text))

    terrain_text = "DEM and ortho bounds are disjoint"
    apart_text = "OSM and terrain bounds are disjoint (disjoint)"
    partial_text = "OSM and terrain partially overlap; using intersection (partial_overlap)"
    warnings = F.array_compact(F.array(
        note(apart_terrain & lenient, terrain_text), note(apart & lenient, apart_text),
        note(partial & (F.col("on_partial") == "warn"), partial_text),
    ))
    errors = F.array_compact(F.array(
        note(apart_terrain & ~lenient, terrain_text), note(apart & ~lenient, apart_text),
        note(partial & (F.col("on_partial") == "fail"), partial_text),
        note((mode == "osm_bbox") & osm.isNull(), "osm_bbox mode requires map data"),
        note((mode == "dem_bounds") & grid.isNull(), "dem_bounds mode requires elevation data"),
        note((mode == "auto") & osm.isNull() & grid.isNull(), "auto extent: no OSM or DEM/ortho inputs available"),
    ))
    out = scenes.select(
        "scene", final.alias("final"), strategy.alias("strategy"), versus.alias("osm_vs_terrain"),
        warnings.alias("warnings"), errors.alias("errors"), "pad_deg",
    )
    missing = (F.size("errors") == 0) & F.col("final").isNull()
    out = out.withColumn(
        "errors", F.when(missing, F.array(F.lit("could not determine final extent"))).otherwise(F.col("errors"))
    )
    good = (F.size("errors") == 0) & F.col("final").isNotNull()
    return out.withColumn("final", F.when(good, frame.box_pad(F.col("final"), F.col("pad_deg")))).drop("pad_deg")


