"""Trees, lamps, signs and their groupings as instance tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import frame, lines, tags
from urbanweave.session import cut_lineage


def tree_instances(nodes: DataFrame) -> DataFrame:
    trees = nodes.where(tags.tag("natural") == "tree")
    return trees.select("osm_id", F.col("x"), F.col("y"), F.lit(0.0).alias("yaw"))


def sampled(ways: DataFrame, spacing: float, *columns: str) -> DataFrame:
    """Stations along ways: the given columns with ``seq, dist, x, y, yaw``."""
    measured = ways.where(F.size("coords") >= 2).withColumn("len", lines.length(F.col("coords"))).where("len > 0")
    spots = measured.select(
        *columns, "coords", "len", F.posexplode(lines.sample_distances(F.col("len"), spacing)).alias("seq", "dist")
    )
    placed = spots.withColumn("p", lines.point_and_yaw(F.col("coords"), F.col("dist"), F.col("len")))
    return placed.where(F.col("p").isNotNull()).select(*columns, "seq", "dist", "p.x", "p.y", "p.yaw")


def lamp_instances(ways: DataFrame, spacing: float = K.LAMP_SPACING_M, scale: float = 1.0) -> DataFrame:
    """Lamps on both sides of the trunk network: ``(osm_id, seq, side, x, y, yaw)``."""
    lit = ways.where(tags.one_of(tags.highway(), K.LAMP_HIGHWAYS))
    lit = lit.withColumn("lateral", tags.road_width(scale=scale) / 2 + K.LAMP_LATERAL_M)
    spots = sampled(lit, spacing, "osm_id", "lateral")
    both = spots.withColumn("side", F.explode(F.array(F.lit(1), F.lit(-1))))
    shift = F.col("side") * F.col("lateral")
    return both.select(
        "osm_id", "seq", "side",
        (F.col("x") + shift * F.sin("yaw")).alias("x"), (F.col("y") - shift * F.cos("yaw")).alias("y"), "yaw",
    )


def sign_placements(
    ways: DataFrame, spacing: float = K.SIGN_SPACING_M, scale: float = 1.0, table: tuple[str, str] | None = None
) -> DataFrame:
    """Name signs on the right side of named major roads: ``(osm_id, seq, x, y, yaw, name)``."""
    named = ways.where(tags.is_major()).withColumn("name", tags.display_name(table=table)).where("name <> ''")
    named = named.withColumn("lateral", tags.road_width(scale=scale) / 2 + K.SIGN_LATERAL_M)
    spots = sampled(named, spacing, "osm_id", "name", "lateral")
    return spots.select(
        "osm_id", "seq",
        (F.col("x") + F.col("lateral") * F.sin("yaw")).alias("x"),
        (F.col("y") - F.col("lateral") * F.cos("yaw")).alias("y"),
        "yaw", "name",
    )


def sign_names(signs: DataFrame, table: tuple[str, str] | None = None) -> DataFrame:
    """All sign names with their rank from zero, most used first: ``(rank, label, n)``; ties go by name.

    The names are sorted into ranges; a rank is the number of names in the ranges before plus the place in its own.
    """
    names = signs.select(tags.to_simplified(F.trim("name"), table).alias("label")).where("label <> ''")
    ranges = names.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")
    ranges = cut_lineage(ranges.withColumn("part", F.spark_partition_id()))
    sizes = ranges.groupBy("part").agg(F.count("*").alias("held"))  # one row per range
    sizes = sizes.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("n"), "label")) - 1
    return ranges.join(sizes, "part").select((F.col("before") + place).alias("rank"), "label", "n")


def instance_transforms(instances: DataFrame) -> DataFrame:
    """Positions in centimetres and orientations as unit quaternions."""
    q = frame.yaw_to_quaternion(F.col("yaw"))
    return instances.withColumns(
        {"x_cm": frame.to_cm(F.col("x")), "y_cm": frame.to_cm(F.col("y")), "qw": q["w"], "qz": q["z"]}
    )


def with_draw_distance(instances: DataFrame, kind: str) -> DataFrame:
    """Add the fade distances of a layer."""
    d = tags.cull_distances(F.lit(kind))
    return instances.withColumns({c: d[c] for c in ("start_m", "end_m", "start_cm", "end_cm")})
