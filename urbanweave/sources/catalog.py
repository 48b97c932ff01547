"""Sharded feature catalogue on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALT = 16


def write_shards(features: DataFrame, path: str) -> None:
    """JSON lines in one folder per shard. A shard is written by up to sixteen tasks, so a full one does not hold up
    the rest; readers prune by the folder name."""
    part = F.pmod(F.xxhash64("osm_type", "osm_id"), F.lit(SALT))
    spread = features.repartition("catalog_shard", part)
    spread.write.mode("overwrite").partitionBy("catalog_shard").json(path)


def read_shards(spark, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
