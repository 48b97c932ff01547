"""Byte-level BPE: ranked merges folded by higher-order functions over distinct words, and decoding by pieces."""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.llm.common import text_of
from urbanweave.llm.shared_arrays import by_shard, found_in, load, new_folder, save, shard_count, word_hashes

PIECE_WORDS = 1 << 18  # that are put together at once; bounds what a worker holds beside its batch
BUCKETS = 1 << 15
NONE, PLACES = 1 << 30, 1 << 32

# Unicode white space, which the splitting pattern calls \s.
SPACE = "\\t-\\r \\u0085\\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000"


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f if line.strip())}


def java_pattern(pattern: str) -> str:
    """The splitting pattern with white space spelled out, as the JVM's own class is ASCII only."""
    return pattern.replace("[^\\s", f"[^{SPACE}").replace("\\S", f"[^{SPACE}]").replace("\\s", f"[{SPACE}]")


def rank_map(ranks: dict[bytes, int]) -> Column:
    """The ranks as one literal: an array of small maps, found by a checksum, because a map lookup is a linear scan.

    A piece is keyed by the string with a character per byte.
    """
    buckets: list[dict[str, int]] = [{} for _ in range(BUCKETS)]
    for piece, rank in ranks.items():
        key = piece.decode("latin-1")
        buckets[zlib.crc32(key.encode()) % BUCKETS][key] = rank
    return F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")


def encode_word(word: Column, ranks: Column) -> Column:
    """Token ids of one word: its own rank if it has one, else its bytes with the lowest-ranked pair merged until none is left.

    The fold's state holds the places where pieces begin, and for each byte the rank of the pair that begins there with its
    place in one number, so that the least is the leftmost of the lowest rank. A merge takes out one place and looks up the
    two pairs beside it only. Arrays are not concatenated, which is slow when interpreted. The rank map is bound to one
    variable, so that the plan that every task reads holds it once.
    """
    return let(ranks, lambda known: merged_ids(word, known))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merged_ids(word: Column, known: Column) -> Column:
    def rank(piece: Column) -> Column:
        return F.element_at(F.get(known, (F.crc32(piece.cast("binary")) % BUCKETS).cast("int")), piece)

    def fold(text: Column) -> Column:
        def ranked(start: Column, end: Column) -> Column:  # of the pair in these bytes; without one of its ends there is none
            found = F.coalesce(rank(F.substring(text, start + 1, end - start)), F.lit(NONE))
            return found.cast("long") * PLACES + start

        def merge(state: Column, _step: Column) -> Column:
            def with_value(value: Column, body: Callable[[Column], Column]) -> Column:  # a fold of one step does not copy its result
                return F.aggregate(F.array(value), state, lambda _, x: body(x))

            def at_place(least: Column) -> Column:
                place = (least % PLACES).cast("int")
                return F.when(least >= NONE * PLACES, state).otherwise(with_value(F.array_position(state["cuts"], place).cast("int"), around))

            def around(i: Column) -> Column:  # the places of the piece before, the pair, the piece after and its end
                near = [F.get(state["cuts"], i + k).alias(name) for k, name in zip(range(-2, 3), "apqrt", strict=True)]
                return with_value(F.struct(*near), cut)

            def cut(near: Column) -> Column:
                a, p, q, r, t = (near[name] for name in "apqrt")
                renewed = F.transform(
                    state["pairs"],
                    lambda x, j: F.when(j == p, ranked(p, t)).when(j == a, ranked(a, r)).when(j == q, NONE * PLACES + j).otherwise(x),
                )
                return F.struct(F.array_remove(state["cuts"], q).alias("cuts"), renewed.alias("pairs"))

            return with_value(F.array_min(state["pairs"]), at_place)

        n = F.length(text)
        start = F.struct(
            F.sequence(F.lit(0), n).alias("cuts"),
            F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i == n - 1, NONE * PLACES + i).otherwise(ranked(i, i + 2))).alias("pairs"),
        )
        merged = F.aggregate(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), start, merge, lambda state: state["cuts"])
        pieces = let(merged, lambda cuts: F.transform(F.slice(cuts, 1, F.size(cuts) - 1), lambda c, k: rank(F.substring(text, c + 1, F.get(cuts, k + 1) - c))))
        return let(rank(text), lambda own: F.when(own.isNotNull(), F.array(own)).otherwise(pieces))

    return let(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), fold)


def encode(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit integers as binary) of every whole text.

    A null text is empty and has no ids. Each row is encoded alone, so repeated rows and null ids keep theirs; an empty
    table gives an empty one; other columns are not read. ``vocabulary`` is the path of the rank file, whose size bounds
    the literal; it is read once on the driver.

    The first pass finds the distinct words of the table, encodes each once on the JVM and writes them by shard of their
    hash to the shared checkpoint folder. The second pass splits the texts again, maps those files into memory and joins
    the ids of its words; no text is shuffled. Words with equal 64-bit hashes would end the job with an error.
    """
    spark = docs.sparkSession
    ranks = rank_map(read_ranks(vocabulary))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = rows.select("doc_id", F.regexp_extract_all("text", F.lit(java_pattern(pattern)), F.lit(0)).alias("words"))
    folder, shards = new_folder(spark, "words"), shard_count(spark)

    def write(words: pa.Table) -> pa.Table:
        shard = words.column("shard")[0].as_py()
        keys, ids = word_hashes(words.column("word").cast(pa.binary()).to_pylist()), words.column("ids").combine_chunks()
        order = np.argsort(keys)
        if (np.diff(keys[order]) == 0).any():
            raise ValueError("two words have one 64-bit hash")
        found, ends = gather(ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), run_edges(ids), order)
        save(folder, f"shard-{shard}", {"keys": keys[order], "ids": found, "edges": ends})
        return pa.table({"shard": pa.array([shard], pa.int32())})

    distinct = rows.select(F.explode("words").alias("word")).distinct()
    distinct = distinct.withColumn("shard", F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(shards)).cast("int")).repartition(shards, "shard")
    encoded = distinct.select("shard", "word", encode_word(F.col("word"), ranks).alias("ids"))
    encoded.groupBy("shard").applyInArrow(write, "shard int").count()

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: dict[int, dict[str, np.ndarray]] = {}
        for batch in batches:
            ends = run_edges(batch.column("words"))
            start = 0
            while start < batch.num_rows:  # pieces of about as many words, a text whole
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + PIECE_WORDS)) - 1)
                piece = batch.slice(start, stop - start)
                words = pa.compute.dictionary_encode(piece.column("words").flatten())
                values, edges = ids_of(words.dictionary, files, folder, shards)
                at = words.indices.to_numpy(zero_copy_only=False)
                ids = joined_runs(values, edges, at, run_edges(piece.column("words")))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), ids], ["doc_id", "ids"])
                start = stop

    return rows.mapInArrow(assemble, "doc_id long, ids binary")


def ids_of(words: pa.Array, files: dict[int, dict[str, np.ndarray]], folder: str, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of distinct words one after another, and where those of each word begin, from the files of their shards."""
    data = words.cast(pa.binary()).to_pylist()
    keys = word_hashes(data)
    found, sizes, order = [np.zeros(0, "<u4")], [], []
    for shard, part in by_shard(np.array([zlib.crc32(w) % shards for w in data], "i8")):
        if shard not in files:
            files[shard] = load(folder, f"shard-{shard}")
        known = files[shard]
        at, there = found_in(keys[part], known["keys"])
        if not there.all():
            raise ValueError("a word was not encoded; the table changed between the passes")
        body, ends = gather(known["ids"], known["edges"], at)
        found.append(body)
        sizes.append(np.diff(ends))
        order.append(part)
    if not order:
        return found[0], np.zeros(1, "i8")
    places, size = np.concatenate(order), np.concatenate(sizes)
    values, edges = np.concatenate(found), np.concatenate([[0], np.cumsum(size)])
    back = np.empty(len(places), "i8")
    back[places] = np.arange(len(places))
    return gather(values, edges, back)


def run_edges(lists: pa.Array) -> np.ndarray:
    """Where the values of each list begin in the flattened array, and the end; null lists are empty."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(sizes, dtype="i8")])


def gather(values: np.ndarray, edges: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``values[edges[k]:edges[k + 1]]`` of each ``k`` in ``at`` one after another, and where each begins, and the end."""
    sizes = edges[at + 1] - edges[at]
    ends = np.concatenate([[0], np.cumsum(sizes, dtype="i8")])
    return values[np.repeat(edges[at] - ends[:-1], sizes) + np.arange(ends[-1])], ends


def joined_runs(values: np.ndarray, edges: np.ndarray, at: np.ndarray, rows: np.ndarray) -> pa.Array:
    """A binary per row: the runs of its places, which are ``at[rows[i]:rows[i + 1]]``."""
    body, ends = gather(values, edges, at.astype("i8"))
    places = (ends[rows] * values.itemsize).astype("i8")
    return pa.Array.from_buffers(pa.large_binary(), len(rows) - 1, [None, pa.py_buffer(places), pa.py_buffer(body)]).cast(pa.binary())


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """``encoded`` with ``decoded``: the binary pieces of its ids, one after another."""
    pieces = {rank: piece for piece, rank in read_ranks(vocabulary).items()}
    sizes = [len(pieces.get(rank, b"")) for rank in range(max(pieces) + 1)]
    table = np.frombuffer(b"".join(pieces[rank] for rank in sorted(pieces)), "u1"), np.concatenate([[0], np.cumsum(sizes, dtype="i8")])
    shared = encoded.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, edges = shared.value
        for batch in batches:
            out = []
            for one in batch.column("ids"):  # row by row: a text may be long
                ids = np.frombuffer(one.as_buffer(), "<u4")
                out.append(joined_runs(values, edges, ids, np.array([0, len(ids)])))
            decoded = pa.concat_arrays(out) if out else pa.array([], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), decoded], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, decoded binary")
