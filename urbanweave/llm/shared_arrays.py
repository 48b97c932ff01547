"""Sorted arrays that tasks write to the folder all executors share and map into memory, and packed keys for shuffles.

Counting passes send one row per block of documents and shard: the sorted distinct keys of the block and their counts as
byte planes, which Spark's shuffle compression shrinks. A shard merges its rows, writes its arrays under a name that
depends on the shard alone, and moves the finished file into place, so a task that runs again writes the same file.
"""

from __future__ import annotations

import json
import mmap
import os
import tempfile
import urllib.parse
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import SparkSession

from urbanweave.session import use_checkpoint_dir

BLOCK_BYTES = 6 << 20  # of text that one block gathers
ALIGN = 64
MIX = np.uint64(0x9E3779B97F4A7C15)


def new_folder(spark: SparkSession, name: str) -> str:
    """A new place in the shared checkpoint folder."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def shard_count(spark: SparkSession) -> int:
    """Shards of a counting pass: as many as the session has shuffle partitions, which its user sizes to the data."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def local_path(uri: str) -> str | None:
    parts = urllib.parse.urlparse(uri)
    return urllib.parse.unquote(parts.path) if parts.scheme in ("", "file") else None


def save(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """One file of aligned arrays, in place at once."""
    head, at, body = {}, 0, []
    for key, values in arrays.items():
        data = np.ascontiguousarray(values).tobytes()
        head[key] = [values.dtype.str, len(values), at]
        pad = -len(data) % ALIGN
        body.append(data + bytes(pad))
        at += len(data) + pad
    told = json.dumps(head).encode()
    told += b" " * (-(len(told) + 8) % ALIGN)
    data = b"".join([len(told).to_bytes(8, "little"), told, *body])
    path = local_path(folder)
    draft = f"{name}.{uuid.uuid4().hex}"
    if path is None:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{draft}") as out:
            out.write(data)
        store.move(f"{root}/{draft}", f"{root}/{name}")
        return
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{draft}", "wb") as out:
        out.write(data)
    os.replace(f"{path}/{draft}", f"{path}/{name}")


def load(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file, mapped. A store without local paths is copied to a file that loses its name at once."""
    path = local_path(folder)
    if path is None:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        with tempfile.TemporaryFile() as copy, store.open_input_stream(f"{root}/{name}") as source:
            while piece := source.read(1 << 22):
                copy.write(piece)
            copy.flush()
            mapped = mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ)
    else:
        with open(f"{path}/{name}", "rb") as source:
            mapped = mmap.mmap(source.fileno(), 0, access=mmap.ACCESS_READ)
    size = int.from_bytes(mapped[:8], "little")
    start = 8 + size
    head = json.loads(mapped[8:start])
    return {k: np.frombuffer(mapped, kind, n, start + at) for k, (kind, n, at) in head.items()}


def byte_planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view("u1").reshape(-1, 8).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, "u1").reshape(8, -1).T).view("<u8").ravel()


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys by their differences."""
    return byte_planes(np.diff(keys.astype("u8"), prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data), dtype="u8")


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads close integers."""
    x = values.astype("u8")
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), "u8", len(words))


def shard_rows(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, bytes, bytes]]:
    """``shard, packed keys, packed counts`` of ascending ``keys``."""
    for name, part in by_shard(shard):
        yield name, packed_keys(keys[part]), byte_planes(counts[part])


def merged(keys: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys of packed rows, and the sums of their counts."""
    key = np.concatenate([unpacked_keys(k) for k in keys])
    count = np.concatenate([from_planes(c) for c in counts]).astype("i8")
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    starts = np.flatnonzero(np.diff(key, prepend=key[:1] + np.uint64(1)))
    return key[starts], np.add.reduceat(count, starts) if len(starts) else count


def found_in(keys: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in an ascending array, and whether it is there."""
    at = np.searchsorted(sorted_keys, keys)
    inside = at < len(sorted_keys)
    there = np.zeros(len(keys), bool)
    there[inside] = sorted_keys[at[inside]] == keys[inside]
    return at, there


def by_shard(shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each shard that occurs, with the places where it does."""
    order = np.argsort(shard, kind="stable")
    names, starts = np.unique(shard[order], return_index=True)
    yield from zip(names.tolist(), np.split(order, starts[1:]), strict=True) if len(names) else ()


def text_blocks(batches: Iterator[pa.RecordBatch], text: str = "text", size_limit: int = BLOCK_BYTES) -> Iterator[pa.Table]:
    """Batches gathered to blocks of about ``size_limit`` bytes of text; a document is never split."""
    held, size = [], 0
    for batch in batches:
        at = 0
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype("i8")
        ends = np.cumsum(sizes)
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = min(int(np.searchsorted(ends, base + size_limit - size)) + 1, batch.num_rows)
            held.append(batch.slice(at, stop - at))
            size += int(ends[stop - 1] - base)
            at = stop
            if size >= size_limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def raw_texts(block: pa.Table, text: str = "text") -> Iterator[bytes]:
    """UTF-8 of each text, null as empty."""
    for chunk in block.column(text).chunks:
        for value in chunk.cast(pa.binary() if pa.types.is_string(chunk.type) else pa.large_binary()):
            yield value.as_py() or b""
