"""Binary 8-bit grey maps (P5): pixel tables in, ordered row bands out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Header: magic, width, height and the greatest value, with comments between.
_HEADER = re.compile(rb"P5(?:\s|#[^\r\n]*[\r\n])+(\d+)(?:\s|#[^\r\n]*[\r\n])+(\d+)(?:\s|#[^\r\n]*[\r\n])+(\d+)\s")
BAND_ROWS = 256


def decode(raw: bytes, path: str) -> np.ndarray:
    match = _HEADER.match(raw)
    if match is None:
        raise ValueError(f"not a binary P5 map: {path}")
    width, height, top = (int(g) for g in match.groups())
    if top != 255:
        raise ValueError(f"expected 8-bit pixels, greatest value {top}: {path}")
    data = np.frombuffer(raw, dtype=np.uint8, offset=match.end())
    if data.size < width * height:
        raise ValueError(f"too few pixels: {path}")
    return data[: width * height].reshape(height, width)


def read_pgm(spark: SparkSession, path: str, background: int | None = None) -> DataFrame:
    """Pixels ``(path, row, col, v)`` of one or more files; pixels of the ``background`` value are left out."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def pixels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, raw in zip(pdf["path"], pdf["content"]):
                grid = decode(bytes(raw), name)
                step = max(1, (1 << 20) // grid.shape[1])
                for top in range(0, grid.shape[0], step):
                    band = grid[top : top + step]
                    rows, cols = np.nonzero(band != background) if background is not None else np.indices(band.shape).reshape(2, -1)
                    yield pd.DataFrame({"path": name, "row": rows + top, "col": cols, "v": band[rows, cols].astype("int32")})

    return files.mapInPandas(pixels, "path string, row long, col long, v int")


def row_bands(px: DataFrame, nrows: int, ncols: int, background: int) -> DataFrame:
    """Dense bytes of every band of rows ``(band, bytes)``; written in band order after the header they are the file."""
    numbered = px.select(F.floor(F.col("row") / BAND_ROWS).alias("band"), "row", "col", "v")
    every = px.sparkSession.range(-(-nrows // BAND_ROWS)).select(
        F.col("id").alias("band"), F.lit(None).cast("long").alias("row"), F.lit(None).cast("long").alias("col"), F.lit(None).cast("int").alias("v")
    )

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        band = int(pdf["band"].iloc[0])
        grid = np.full((min(BAND_ROWS, nrows - band * BAND_ROWS), ncols), background, dtype=np.uint8)
        set_px = pdf.dropna()
        grid[set_px["row"].astype(int) - band * BAND_ROWS, set_px["col"].astype(int)] = set_px["v"].astype(np.uint8)
        return pd.DataFrame({"band": [band], "bytes": [grid.tobytes()]})

    return numbered.unionByName(every).groupBy("band").applyInPandas(fill, "band long, bytes binary")


def header(nrows: int, ncols: int) -> bytes:
    return f"P5\n{ncols} {nrows}\n255\n".encode("ascii")


def write_pgm(px: DataFrame, path: str, nrows: int, ncols: int, background: int) -> None:
    """One map file, band after band; the driver holds a single band at a time."""
    with open(path, "wb") as f:
        f.write(header(nrows, ncols))
        for row in row_bands(px, nrows, ncols, background).orderBy("band").toLocalIterator():
            f.write(row["bytes"])
