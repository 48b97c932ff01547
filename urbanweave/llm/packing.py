"""Packing of tokenised documents into sequences of one length, as a cutting-stock problem."""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanweave.llm.common import text_of
from urbanweave.session import cut_lineage

CAPACITY = 2048
END_ID = 1
STEP = 8  # lengths are planned in classes of this many tokens
GAP = 2e-3  # the linear program stops this close to its bound
ROUNDS = 4000
CACHED_WORDS = 400_000

# Latin characters up to here are in composed form already and lower-cased one by one.
LATIN_END = "\u0180"
LATIN = list(map(chr, range(ord(LATIN_END))))
LETTERS = "".join(c for c in LATIN if c.isalpha())
NUMBERS = "".join(c for c in LATIN if unicodedata.category(c)[0] == "N")
# The splitting pattern of the vocabulary, for lower-cased Latin text.
STEMS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\t-\r \x85\xa0{LETTERS}{NUMBERS}]+").findall

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, class int, rank long"


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Token ids of a text as little-endian bytes, word by word through a cache.

    Spaces and newlines always end a word of this vocabulary (its splitter drops white space), so the text is cut only
    there. A Latin word is cut further where the splitter cuts it and its stems go straight to the merges, so a stem is
    encoded once for all words that hold it. Other words, which the normaliser may change, go through the whole
    tokenizer. Both caches are emptied when full.
    """

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer = Tokenizer.from_str(model.decode())
        tokenizer.encode_special_tokens = True
        merges = tokenizer.model
        by_byte = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        written = {ord(c): by_byte.pre_tokenize_str(c)[0][0] for c in LATIN}

        class Stems(dict):
            def __missing__(self, stem: str) -> bytes:
                if len(self) >= CACHED_WORDS:
                    self.clear()
                ids = packed([t.id for t in merges.tokenize(stem.translate(written))])
                self[stem] = ids
                return ids

        class Words(dict):
            def __init__(self, stems: Stems):
                self.stems = stems

            def __missing__(self, word: str) -> bytes:
                if len(self) >= CACHED_WORDS:
                    self.clear()
                if word.isascii() or (max(word) < LATIN_END and "\u0130" not in word):  # that letter becomes two
                    ids = b"".join([self.stems[stem] for stem in STEMS(word.lower())])
                else:
                    ids = packed(tokenizer.encode(word, add_special_tokens=False).ids)
                self[word] = ids
                return ids

        self.cache = Words(Stems())

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, text.replace("\n", " ").split(" ")))


@lru_cache(maxsize=1)
def word_encoder(model: bytes) -> WordEncoder:
    """One encoder per Python worker, so that its caches serve all tasks that the worker runs."""
    return WordEncoder(model)


def tokenised_pieces(docs: DataFrame, spark: SparkSession, model: str, id_col: str, text_col: str, capacity: int) -> DataFrame:
    """Pieces of every document: as many full ones as fit, then the rest with its length class.

    ``task`` and ``rank`` number the rests of a class within the task that made them; the result must be materialised
    before use, so both stay as they are.
    """
    with open(model, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, task = word_encoder(shared.value), TaskContext.get().partitionId()
        ranks = np.zeros(capacity // STEP + 2, "int64")
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                ids = encoder.encode(text) + end
                n = len(ids) // 4
                for start in range(0, n, capacity):
                    length = min(capacity, n - start)
                    kind = 0 if length == capacity else -(-length // STEP)
                    out.append((doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, task, kind, int(ranks[kind])))
                    ranks[kind] += 1
            columns = list(zip(*out, strict=True)) or [[]] * 8
            types = [pa.int64()] * 6 + [pa.int32(), pa.int64()]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "class", "rank"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, PIECE)


def best_pattern(prices: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming over the capacity: the dearest pattern, as counts per size."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        k = int(np.searchsorted(sizes, c, "right"))
        value[c] = value[c - 1]
        if k:
            gains = prices[:k] + value[c - sizes[:k]]
            best = int(np.argmax(gains))
            if gains[best] > value[c] + 1e-12:
                value[c], choice[c] = gains[best], best
    counts, c = np.zeros(len(sizes)), capacity
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            counts[choice[c]] += 1
            c -= int(sizes[choice[c]])
    return float(value[capacity]), counts


def linear_program(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Column generation by the revised simplex method: patterns (columns) of the basis and how often each is used."""
    m = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    inverse = np.diag(1.0 / np.diag(basis))
    used = inverse @ demand
    for _ in range(ROUNDS):
        prices = np.maximum(inverse.sum(axis=0), 0.0)
        worth, pattern = best_pattern(prices, sizes, capacity)
        if worth <= 1 + GAP:
            break
        column = inverse @ pattern
        ratio = np.where(column > 1e-9, used / np.maximum(column, 1e-9), np.inf)
        leaving = int(np.argmin(ratio))
        step = ratio[leaving]
        if not np.isfinite(step):
            break
        used = used - step * column
        used[leaving] = step
        row = inverse[leaving] / column[leaving]
        inverse -= np.outer(column, row)
        inverse[leaving] = row
        basis[:, leaving] = pattern
        used = np.maximum(used, 0.0)
    return basis, used


def plan_patterns(classes: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """How often to use which pattern, so that every document of the histogram has a place.

    Works on the histogram of length classes only, whose size is bounded by the capacity. The solution of the linear
    program is rounded down; what is left (under one use of each pattern of the basis) is filled sequence by sequence.
    """
    plan: list[tuple[int, dict[int, int]]] = []
    left = counts.astype("int64").copy()
    if len(classes):
        basis, used = linear_program(classes.astype("int64"), counts.astype(float), capacity)
        whole = np.floor(used + 1e-9).astype("int64")
        for j in np.flatnonzero(whole):
            pattern = {int(i): int(basis[i, j]) for i in np.flatnonzero(basis[:, j])}
            times = min([int(whole[j]), *(int(left[i] // n) for i, n in pattern.items())])
            if times:
                plan.append((times, pattern))
                for i, n in pattern.items():
                    left[i] -= times * n
    while left.any():
        pattern = fullest(classes, left, capacity)
        plan.append((1, pattern))
        for i, n in pattern.items():
            left[i] -= n
    return plan


def fullest(classes: np.ndarray, left: np.ndarray, capacity: int) -> dict[int, int]:
    """The longest class left, with the items left that fill the rest of the sequence best (bounded knapsack)."""
    first = int(np.flatnonzero(left)[-1])
    room = capacity - int(classes[first])
    by = np.full(room + 1, -1)  # the class that reached a fill
    by[0] = len(classes)
    for k in range(first, -1, -1):
        if by[room] >= 0:
            break
        size = int(classes[k])
        for _ in range(min(int(left[k]) - (k == first), room // size)):
            new = np.flatnonzero(by[: room + 1 - size] >= 0) + size
            new = new[by[new] < 0]
            if not len(new):
                break
            by[new] = k
    pattern, fill = {first: 1}, int(np.flatnonzero(by >= 0)[-1])
    while fill:
        k = int(by[fill])
        pattern[k] = pattern.get(k, 0) + 1
        fill -= int(classes[k])
    return pattern


def slots(classes: np.ndarray, plan: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """Ranges of ranks of each class and the sequences they go to: bounded by the plan, not by the documents."""
    rows, sequence, given = [], 0, dict.fromkeys(range(len(classes)), 0)
    for times, pattern in plan:
        for i, n in pattern.items():
            rows.append((int(classes[i]), given[i], n, sequence))
            given[i] += n * times
        sequence += times
    rows.sort()
    columns = np.array(rows, "int64").reshape(-1, 4).T
    return {"class": columns[0], "first": columns[1], "each": columns[2], "sequence": columns[3]} | {"total": np.array([sequence])}


def pack(
    docs: DataFrame, spark: SparkSession, model: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document longer than ``capacity`` fills sequences of its own and leaves a rest. Rests are counted per length
    class; the cutting-stock problem of that histogram is solved on the driver (at most ``capacity / 8`` numbers, whatever
    the corpus), and rests take the places of their class by rank. A null text is empty and holds only the end id;
    repeated rows and null ids are packed like others; an empty table gives an empty one; other columns are not read.

    Ranks come from counts per task and class, so a class that holds most documents is never gathered: only the counts
    meet in a window.
    """
    pieces = cut_lineage(tokenised_pieces(docs, spark, model, id_col, text_col, capacity))
    per_task = pieces.groupBy("class", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("class").orderBy("task")) - F.col("n")
    bases = cut_lineage(per_task.withColumn("base", before))
    histogram = bases.groupBy("class").agg(F.sum("n").alias("n")).where("class > 0").orderBy("class").collect()
    classes, counts = (np.array([r[k] for r in histogram], "int64") for k in ("class", "n"))
    planned = slots(classes, plan_patterns(classes, counts, capacity // STEP))
    shared = spark.sparkContext.broadcast(planned)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = shared.value
        edge = np.int64(1) << 40  # ranks stay below this
        starts = at["class"] * edge + at["first"]
        for batch in batches:
            kind = batch.column("class").to_numpy(zero_copy_only=False).astype("int64")
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            sequence = rank + at["total"][0]  # full pieces: a sequence each, after the planned ones
            rest = kind > 0
            if rest.any():
                k = np.searchsorted(starts, kind[rest] * edge + rank[rest], "right") - 1
                sequence[rest] = at["sequence"][k] + (rank[rest] - at["first"][k]) // at["each"][k]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence)], [*names, "sequence_id"])

    ranked = pieces.join(bases.select("class", "task", "base"), ["class", "task"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("base")).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "rank")
    placed = ranked.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long")
    order = W.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start")
    return placed.withColumn("offset", F.sum("length").over(order) - F.col("length"))
