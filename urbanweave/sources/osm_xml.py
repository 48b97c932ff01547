"""OpenStreetMap XML as node, reference and tag tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TAGS = T.StructField("tag", T.ArrayType(T.StructType([T.StructField("_k", T.StringType()), T.StructField("_v", T.StringType())])))
_NODE = T.StructType([
    T.StructField("_id", T.LongType()), T.StructField("_lon", T.DoubleType()), T.StructField("_lat", T.DoubleType()), _TAGS,
])
_WAY = T.StructType([
    T.StructField("_id", T.LongType()),
    T.StructField("nd", T.ArrayType(T.StructType([T.StructField("_ref", T.LongType())]))), _TAGS,
])


def _tag_map():
    """Tags as a map; of a repeated key the last value counts."""
    pairs = F.coalesce("tag", F.array().cast(_TAGS.dataType))
    keys = F.transform(pairs, lambda t: t["_k"])
    last = F.filter(
        F.transform(pairs, lambda t, i: F.struct(t["_k"].alias("key"), t["_v"].alias("value"), i.alias("i"))),
        lambda e: ~F.array_contains(F.slice(keys, e["i"] + 2, F.size(keys)), e["key"]),
    )
    return F.map_from_entries(F.transform(last, lambda e: F.struct(e["key"], e["value"])))


def read_osm_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Tables of an XML file: nodes ``(node_id, lon, lat, tags)``, references ``(way_id, pos, ref)`` and way tags
    ``(way_id, tags)``. The file is split by Spark; nothing passes through the driver."""
    reader = spark.read.format("xml").option("mode", "FAILFAST")
    nodes = reader.schema(_NODE).option("rowTag", "node").load(path)
    ways = spark.read.format("xml").option("mode", "FAILFAST").schema(_WAY).option("rowTag", "way").load(path)
    return (
        nodes.select(F.col("_id").alias("node_id"), F.col("_lon").alias("lon"), F.col("_lat").alias("lat"), _tag_map().alias("tags")),
        ways.select(F.col("_id").alias("way_id"), F.posexplode("nd").alias("pos", "n")).select("way_id", "pos", F.col("n._ref").alias("ref")),
        ways.select(F.col("_id").alias("way_id"), _tag_map().alias("tags")),
    )
