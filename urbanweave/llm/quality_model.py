"""A quality classifier: random-indexing word vectors pooled per document, and a small network on top.

The word vectors are learned from all texts. A task sums, for each distinct word of a block, the index vectors of the words
around it; shards add these integer sums and write unit vectors of one byte per dimension to the folder all executors share.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanweave.llm.common import text_of
from urbanweave.llm.lm_score import END, read_stream
from urbanweave.llm.shared_arrays import (
    by_shard, found_in, load, mixed, new_folder, packed_keys, raw_texts, save, shard_count, text_blocks, unpacked_keys, word_hashes,
)
from urbanweave.session import cut_lineage

DIMS, NONZERO = 48, 6  # of a random index vector
SHAPES = 16  # hashed dimensions of word shapes
STATS = 5
WIDTH = DIMS + SHAPES
UNIT = 127  # length of a stored vector
REACH = 2  # words of context on either side; at most 2, as two ends stand between texts
BLOCK = 16 << 20  # of text that one block of the counting pass gathers
POOLED = 4 << 20  # of text that is pooled at once
STEP = 1 << 15  # words that are expanded to vectors at once
MIN_COUNT = 2  # a word seen once has no vector: it could only repeat the words around it
SAMPLE_DOCS = 6_000  # labelled documents that the network is fitted on, at most
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 60, 64, 3e-3, 1e-4
TEST_FOLDS, TEST_FOLD = 5, 0
CUT = 0.3

MARKS = re.compile(r"[#*$%&|<>]")
LETTERS = string.ascii_letters.encode()
SUMS = "shard int, bytes int, keys binary, sums binary"


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """The sparse ternary vectors of words: places and signs from independent mixes of the words' 64-bit hashes."""
    out = np.zeros((len(hashes), DIMS), "i1")
    rows = np.arange(len(hashes))
    for k in range(1, NONZERO + 1):
        draw = mixed(hashes + np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        out[rows, (draw % np.uint64(DIMS)).astype("i8")] += np.where(draw >> np.uint64(63), 1, -1).astype("i1")
    return out


def shape_of(word: str) -> str:
    if word.isascii() and word.isalpha():
        return f"{'A' if len(word) > 1 and word.isupper() else 'a'}{len(word) // 6}"
    letters = [c for c in word if c.isalpha()]
    case = "0" if not letters else "A" if len(letters) > 1 and all(c.isupper() for c in letters) else "a"
    tail = "".join(sorted(set(word) - set(letters)))[:2] if len(letters) < len(word) else ""
    return f"{case}{'s' if MARKS.search(word) else ''}{'!' if '!!' in word else ''}{len(word) // 6}{tail[:1]}"


def shape_place(word: bytes) -> int:
    """Hashed dimension of a word's shape."""
    if not word.isascii():
        return hashed_place(shape_of(word.decode("utf-8", "replace")))
    other = word.translate(None, LETTERS)
    letters = len(word) - len(other)
    return ascii_place(letters > 0, letters > 1 and word.isupper(), bool(MARKS.search(other.decode())), b"!!" in word, len(word) // 6, min(other, default=-1))


@lru_cache(65536)
def ascii_place(letters: bool, upper: bool, marks: bool, loud: bool, length: int, other: int) -> int:
    case = ("A" if upper else "a") if letters else "0"
    return hashed_place(f"{case}{'s' if marks else ''}{'!' if loud else ''}{length}{chr(other) if other >= 0 else ''}")


def hashed_place(shape: str) -> int:
    return DIMS + zlib.crc32(shape.encode()) % SHAPES


def block_sums(texts: Iterator[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ascending hashes of the words of a block, and per word the sum of the index vectors around it and its count."""
    s = read_stream(texts)
    hashes = word_hashes(s.words)
    index, sums = index_vectors(hashes), np.zeros((len(hashes), DIMS + 1), "i4")
    index[s.words.index(END) if len(s.codes) else slice(0)] = 0
    for start in range(0, len(s.codes), STEP):
        low, high = max(start - REACH, 0), min(start + STEP + REACH, len(s.codes))
        near = index[s.codes[low:high]]
        around = np.zeros_like(near)
        for d in range(1, REACH + 1):
            around[d:] += near[:-d]
            around[:-d] += near[d:]
        codes, around = s.codes[start : start + STEP], around[start - low : start - low + STEP]
        order = np.argsort(codes, kind="stable")
        first = np.flatnonzero(np.diff(codes[order], prepend=-1))
        sums[codes[order[first]], :DIMS] += np.add.reduceat(around[order].astype("i4"), first, axis=0)
    sums[:, DIMS] = np.bincount(s.codes, minlength=len(hashes))
    keep = np.array([w != END for w in s.words], bool)
    order = np.flatnonzero(keep)
    order = order[np.argsort(hashes[order])]
    return hashes[order], sums[order]


def count_contexts(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """``SUMS`` per block and shard: sums that fit go as one byte a dimension, the others as four."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for block in text_blocks(batches, size_limit=BLOCK):
        hashes, sums = block_sums(raw_texts(block))
        small = np.maximum(sums.max(axis=1, initial=0), -sums.min(axis=1, initial=0)) <= 127
        rows = []
        for size, chosen in ((1, small), (4, ~small)):
            places = np.flatnonzero(chosen)
            for shard, at in by_shard((hashes[places] % np.uint64(shards)).astype("i8")):  # copies are made a shard at a time
                values = np.ascontiguousarray(sums[places[at]].astype(f"i{size}").T)
                rows.append((shard, size, pack(packed_keys(hashes[places[at]])), pack(values.tobytes())))
        columns = zip(*rows, strict=True) if rows else ((), (), (), ())
        kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["shard", "bytes", "keys", "sums"])


def merge_contexts(folder: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Adds the sums of one shard and writes its vectors; only the shard's number and size are returned."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        keys = [unpacked_keys(unpack(k)) for k in rows["keys"]]
        parts = [np.frombuffer(unpack(v), f"i{size}").reshape(DIMS + 1, -1).T for v, size in zip(rows["sums"], rows["bytes"], strict=True)]
        key, sums = np.concatenate(keys), np.concatenate([p.astype("i8") for p in parts])
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=key[order[:1]] + np.uint64(1)))
        key, sums = key[order][first], np.add.reduceat(sums[order], first, axis=0)
        kept = sums[:, DIMS] >= MIN_COUNT
        key, sums = key[kept], sums[kept, :DIMS].astype("f8")
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        vectors = np.rint(UNIT * sums / np.where(length > 0, length, 1)).astype("i1")
        shard = int(rows["shard"].iloc[0])
        save(folder, str(shard), {"hash": key, "vector": vectors.ravel()})
        return pd.DataFrame({"shard": [shard], "n": [len(key)]})

    return merge


@dataclass
class Vectors:
    """Where the word vectors lie; no vector passes through the driver."""

    folder: str
    shards: int
    filled: frozenset[int]


def learn_vectors(docs: DataFrame, text_col: str = "text") -> Vectors:
    """Context vectors of all words that the texts of ``docs`` hold at least twice."""
    spark = docs.sparkSession
    folder, shards = new_folder(spark, "vectors"), shard_count(spark)
    sums = docs.select(F.col(text_col).alias("text")).mapInArrow(lambda b: count_contexts(b, shards), SUMS)
    done = cut_lineage(sums.groupBy("shard").applyInPandas(merge_contexts(folder), "shard int, n long"))
    return Vectors(folder, shards, frozenset(r["shard"] for r in done.where("n > 0").collect()))  # a row per shard


class Pooler:
    """Features of texts: mean vector and word shapes, and some ratios. Files are mapped when first needed."""

    def __init__(self, vectors: Vectors):
        self.vectors, self.files = vectors, {}

    def matrix(self, words: list[bytes]) -> np.ndarray:
        """Row per word: its context vector (zeros if it has none), then its hashed shape, both of length ``UNIT``."""
        out = np.zeros((len(words), WIDTH), "i1")
        hashes = word_hashes([w.lower() for w in words])
        for shard, at in by_shard((hashes % np.uint64(self.vectors.shards)).astype("i8")):
            if shard in self.vectors.filled:
                if shard not in self.files:
                    self.files[shard] = load(self.vectors.folder, str(shard))
                f = self.files[shard]
                place, there = found_in(hashes[at], f["hash"])
                out[at[there], :DIMS] = f["vector"].reshape(-1, DIMS)[place[there]]
        out[np.arange(len(words)), [shape_place(w) for w in words]] = UNIT
        return out

    def pooled(self, texts: list[str]) -> np.ndarray:
        """Features per whole text; zeros for a text without words. Sums are of integers, so blocks change nothing."""
        out, start, size = np.zeros((len(texts), WIDTH + STATS)), 0, 0
        for k, text in enumerate(texts):
            size += len(text)
            if size >= POOLED or k == len(texts) - 1:
                self.pool_block(texts[start : k + 1], out[start : k + 1])
                start, size = k + 1, 0
        return out

    def pool_block(self, texts: list[str], out: np.ndarray) -> None:
        names: defaultdict[bytes, int] = defaultdict()
        names.default_factory = names.__len__
        parts, code_of = [], names.__getitem__
        for text in texts:
            words = text.encode("utf-8", "replace").split()
            parts.append(np.fromiter(map(code_of, words), "i8", len(words)))
        codes, n = np.concatenate(parts), np.array([len(p) for p in parts], "i8")
        if not len(codes):
            return
        doc = np.repeat(np.arange(len(texts)), n)
        pairs, counts = np.unique(doc * len(names) + codes, return_counts=True)
        owner, code = pairs // len(names), pairs % len(names)
        matrix, sums = self.matrix(list(names)), np.zeros((len(texts), WIDTH))
        for start in range(0, len(pairs), STEP):
            at = slice(start, start + STEP)
            first = np.flatnonzero(np.diff(owner[at], prepend=-1))
            weighted = matrix[code[at]] * counts[at, None].astype("f8")  # whole numbers below 2 ** 53
            sums[owner[at][first]] += np.add.reduceat(weighted, first, axis=0)
        has, total = n > 0, np.maximum(n, 1)
        out[:, :WIDTH] = sums / (UNIT * total[:, None])
        same = np.bincount(doc[1:][(codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])], minlength=len(texts))
        most = np.zeros(len(texts))
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        most[owner[first]] = np.maximum.reduceat(counts, first)
        out[:, WIDTH] = np.bincount(owner, minlength=len(texts)) / total**0.8
        out[:, WIDTH + 1] = same / np.maximum(n - 1, 1)
        out[:, WIDTH + 2] = most / total
        out[:, WIDTH + 3] = np.log1p(n) / 5
        out[has, WIDTH + 4] = [sum(t.count(c) for c in "#*$%&|<>!") / len(t) for t, h in zip(texts, has, strict=True) if h]


@dataclass
class Model:
    vectors: Vectors
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.maximum(z @ self.w1 + self.b1, 0.0) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, vectors: Vectors) -> Model:
    """Two layers trained by Adam on four fifths of the rows; the temperature minimises the loss of the last fifth."""
    rng = np.random.default_rng(11)
    x, y = x.astype("float64"), y.astype("float64")
    if len(y) == 0:
        z = np.zeros(WIDTH + STATS)
        return Model(vectors, z, z + 1, np.zeros((len(z), HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 1.0)
    order = rng.permutation(len(y))
    held, rest = order[: len(y) // 5], order[len(y) // 5 :]
    mean, scale = x[rest].mean(0), x[rest].std(0) + 1e-3
    z = (x - mean) / scale
    params = [rng.normal(0, (2 / z.shape[1]) ** 0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, (1 / HIDDEN) ** 0.5, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    t = 0
    for _ in range(EPOCHS):
        mixed = rng.permutation(rest)
        for k in range(0, len(mixed), BATCH):
            rows = mixed[k : k + BATCH]
            a = z[rows]
            h = np.maximum(a @ params[0] + params[1], 0.0)
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
            d = (p - y[rows]) / len(rows)
            dh = np.outer(d, params[2]) * (h > 0)
            grads = [a.T @ dh + DECAY * params[0], dh.sum(0), h.T @ d + DECAY * params[2], np.array([d.sum()])]
            t += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - RATE * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    model = Model(vectors, mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    if len(held):
        logits = model.logits(x[held])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 61))
        loss = [np.logaddexp(0, np.where(y[held] > 0.5, -logits, logits) / g).mean() for g in grid]
        model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fold(id_column: Column) -> Column:
    return F.pmod(F.crc32(id_column.cast("string").cast("binary")), F.lit(TEST_FOLDS))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """At most ``SAMPLE_DOCS`` labelled documents outside the test fold, the first by a hash of the id."""
    chosen = labels.where(F.col(label_col).isNotNull() & (fold(F.col(id_col)) != TEST_FOLD))
    chosen = chosen.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_DOCS)  # the documented bound
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.max("text").alias("text"), F.max("label").alias("label"))
    return cut_lineage(sample)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Word vectors from all texts of ``docs``; the network is fitted on the bounded sample of labelled documents.

    The driver holds the features of the sample only. Null and empty texts add no words. Without labelled documents the
    model says 0.5 for every text.
    """
    vectors = learn_vectors(docs, text_col)
    sample = labelled_sample(docs, labels, id_col, text_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pooler = Pooler(vectors)
        for batch in batches:
            x = pooler.pooled(batch.column("text").to_pylist()).tolist()
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(x, pa.list_(pa.float64()))], ["id", "label", "x"])

    rows = sample.select(F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"), "text")
    rows = rows.mapInArrow(run, "id long, label int, x array<double>").orderBy(F.xxhash64("id"), "id").collect()
    x = np.array([r["x"] for r in rows]).reshape(len(rows), WIDTH + STATS)
    return fit_network(x, np.array([r["label"] for r in rows]), vectors)


def scorer(model: Model, spark: SparkSession) -> Callable[[Column], Column]:
    """A column function from text to the calibrated probability of label 1."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = shared.value
        pooler = Pooler(known.vectors)
        for texts in batches:
            yield pd.Series(known.scores(pooler.pooled(list(texts))))

    return score


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """``row`` (the whole input row), ``held_out``, ``score`` and ``predicted`` for every document.

    Null and empty texts get the score of a text without words. Rows are scored alone by their text only: repeated
    rows get equal scores, a null id is not held out, an empty table gives an empty one, and other columns stay in ``row``.
    """
    rows = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("text"), F.col(id_col).alias("id"))
    score = scorer(model, docs.sparkSession)
    rows = rows.select("row", F.coalesce(fold(F.col("id")) == TEST_FOLD, F.lit(False)).alias("held_out"), score(F.col("text")).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= cut).cast("int"))
