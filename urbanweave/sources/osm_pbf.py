"""OpenStreetMap PBF as a Spark data source: one input partition per file block, decoded on the executors.

``spark.dataSource.register(OsmPbfSource)``, then ``spark.read.format("osm_pbf").load(path)`` gives rows
``(kind, id, lon, lat, tags, refs)`` of kind ``node`` or ``way``; relations are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "kind string, id long, lon double, lat double, tags map<string,string>, refs array<long>"
ARROW = pa.schema([
    ("kind", pa.string()), ("id", pa.int64()), ("lon", pa.float64()), ("lat", pa.float64()),
    ("tags", pa.map_(pa.string(), pa.string())), ("refs", pa.list_(pa.int64())),
])
ROWS_PER_BATCH = 8192


def varints(data: bytes) -> Iterator[int]:
    """Base-128 numbers of a packed field."""
    value = shift = 0
    for byte in data:
        value |= (byte & 127) << shift
        if byte & 128:
            shift += 7
        else:
            yield value
            value = shift = 0


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of every field of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = number() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


def signed(value: int) -> int:
    return (value >> 1) ^ -(value & 1)


def running(data: bytes) -> Iterator[int]:
    """Delta-coded signed numbers."""
    total = 0
    for value in varints(data):
        total += signed(value)
        yield total


def block_rows(blob: bytes) -> Iterator[dict]:
    """Nodes and ways of one data block."""
    parts = dict(fields(blob))
    data = parts[1] if 1 in parts else zlib.decompress(parts[3])
    strings: list[str] = []
    groups, scale, lat0, lon0 = [], 100, 0, 0
    for no, value in fields(data):
        if no == 1:
            strings = [text.decode("utf-8") for _, text in fields(value)]
        elif no == 2:
            groups.append(value)
        elif no == 17:
            scale = value
        elif no == 19:
            lat0 = value
        elif no == 20:
            lon0 = value

    def degrees(raw: int, offset: int) -> float:
        return (offset + scale * raw) / 1e9

    def tag_list(keys: bytes, values: bytes) -> list[tuple[str, str]]:
        return list({strings[k]: strings[v] for k, v in zip(varints(keys), varints(values))}.items())

    for group in groups:
        for no, value in fields(group):
            if no not in (1, 2, 3):
                continue
            f = dict(fields(value))
            if no == 2:
                tags = _dense_tags(f.get(10, b""), strings)
                for i, lat, lon in zip(running(f[1]), running(f[8]), running(f[9])):
                    yield {"kind": "node", "id": i, "lon": degrees(lon, lon0), "lat": degrees(lat, lat0), "tags": next(tags), "refs": []}
            elif no == 1:
                yield {"kind": "node", "id": signed(f[1]), "lon": degrees(signed(f[9]), lon0), "lat": degrees(signed(f[8]), lat0),
                       "tags": tag_list(f.get(2, b""), f.get(3, b"")), "refs": []}
            else:
                yield {"kind": "way", "id": f[1], "lon": None, "lat": None, "tags": tag_list(f.get(2, b""), f.get(3, b"")),
                       "refs": list(running(f.get(8, b"")))}


def _dense_tags(data: bytes, strings: list[str]) -> Iterator[list[tuple[str, str]]]:
    """Tags node by node; each node's run of key and value numbers ends with a zero."""
    found: dict[str, str] = {}
    numbers = varints(data)
    for key in numbers:
        if key == 0:
            yield list(found.items())
            found = {}
        else:
            found[strings[key]] = strings[next(numbers)]
    while True:
        yield []


class Block(InputPartition):
    def __init__(self, path: str, offset: int, size: int):
        self.path, self.offset, self.size = path, offset, size


class OsmPbfReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Block]:
        """Data blocks of the file, found by walking the block headers only."""
        blocks = []
        with open(self.path, "rb") as f:
            while head := f.read(4):
                header = dict(fields(f.read(struct.unpack(">I", head)[0])))
                if header[1] == b"OSMData":
                    blocks.append(Block(self.path, f.tell(), header[3]))
                f.seek(header[3], 1)
        return blocks or [Block(self.path, 0, 0)]

    def read(self, partition: Block) -> Iterator[pa.RecordBatch]:
        if not partition.size:
            return
        with open(partition.path, "rb") as f:
            f.seek(partition.offset)
            rows = list(block_rows(f.read(partition.size)))
        for i in range(0, len(rows), ROWS_PER_BATCH):
            yield pa.RecordBatch.from_pylist(rows[i : i + ROWS_PER_BATCH], schema=ARROW)


class OsmPbfSource(DataSource):
    """Blocks hold at most 32 MiB by the format, which bounds a partition."""

    @classmethod
    def name(cls) -> str:
        return "osm_pbf"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> OsmPbfReader:
        return OsmPbfReader(self.options["path"])


def read_osm_pbf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The same tables as for XML: nodes, references and way tags."""
    spark.dataSource.register(OsmPbfSource)
    rows = spark.read.format("osm_pbf").load(path)
    ways = rows.where("kind = 'way'")
    return (
        rows.where("kind = 'node'").select(F.col("id").alias("node_id"), "lon", "lat", "tags"),
        ways.select(F.col("id").alias("way_id"), F.posexplode("refs").alias("pos", "ref")),
        ways.select(F.col("id").alias("way_id"), "tags"),
    )
