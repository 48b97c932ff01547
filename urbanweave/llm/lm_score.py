"""Scores of texts under an n-gram model of the corpus that lies in Elias-Fano tries."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.llm.ngram_trie import Level, level_arrays, restored, runs
from urbanweave.llm.shared_arrays import (
    by_shard, byte_planes, found_in, from_planes, load, merged, mixed, new_folder, raw_texts, save, shard_count, shard_rows, text_blocks, word_hashes,
)
from urbanweave.session import cut_lineage

ORDER = 2
CORPUS_ORDER = 5  # words of the longest n-grams when a whole corpus is scored
DISCOUNT = 0.75
FOLDS, HELD_FOLD = 7, 2
END = b""  # no word is empty
HEAVY = 4  # a context with more than 1 / (HEAVY * shards) of all tokens is split over the shards
ROWS = "shard int, keys binary, counts binary"
MERGED = "shard int, n long, total long, top binary, top_counts binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@dataclass
class Model:
    """Where the levels lie: sizes and the few heavy contexts, no counts of the corpus."""

    folder: str
    shards: int
    tokens: int = 0
    words: int = 0
    end: int = -1  # id of the end of a text
    starts: list[np.ndarray] = field(default_factory=list)  # first id of each shard, by level
    heavy: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # contexts and their counts, by level


class Reader:
    """The files of a model in this process, opened when first needed."""

    def __init__(self, model: Model):
        self.model, self.files, self.shared = model, {}, {}

    def file(self, level: int, shard: int):
        if (level, shard) not in self.files:
            arrays = load(self.model.folder, f"{level}-{shard}")
            self.files[level, shard] = arrays if level == 1 else Level(arrays)
        return self.files[level, shard]

    def lookup(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: not in the training part) and counts of words."""
        m, hashes = self.model, word_hashes(words)
        ids, counts = np.full(len(words), -1, "i8"), np.zeros(len(words), "i8")
        for shard, at in by_shard((hashes % np.uint64(m.shards)).astype("i8")):
            if m.starts[0][shard + 1] > m.starts[0][shard]:
                f = self.file(1, shard)
                place, there = found_in(hashes[at], f["hash"])
                ids[at[there]] = m.starts[0][shard] + place[there]
                counts[at[there]] = f["count"][place[there]]
        return ids, counts

    def heavy_backoff(self, level: int) -> np.ndarray:
        """Backoff of the heavy contexts: the sum of what their shards hold."""
        if level not in self.shared:
            heavy = self.model.heavy[level - 2][0]
            self.shared[level] = sum((self.backoff_in(level, s, heavy) for s in range(self.model.shards)), np.zeros(len(heavy)))
        return self.shared[level]

    def backoff_in(self, level: int, shard: int, parents: np.ndarray) -> np.ndarray:
        out = np.zeros(len(parents))
        if self.model.starts[level - 1][shard + 1] > self.model.starts[level - 1][shard]:
            f = self.file(level, shard)
            at, there = f.contexts(parents)
            out[there] = restored(f.backoff[at[there]])
        return out

    def search(self, level: int, parents: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Node (-1: not seen), discounted probability and backoff of ascending pairs of contexts and words (-1: unknown word)."""
        m = self.model
        node, p, backoff = np.full(len(parents), -1, "i8"), np.zeros(len(parents)), np.zeros(len(parents))
        contexts, inverse = runs(parents)
        place, is_heavy = found_in(contexts, m.heavy[level - 2][0])
        gamma = np.zeros(len(contexts))
        gamma[is_heavy] = self.heavy_backoff(level)[place[is_heavy]]
        for shard, at in by_shard(np.where(is_heavy, -1, home(contexts, m.shards))):
            if shard >= 0:
                gamma[at] = self.backoff_in(level, shard, contexts[at])
        backoff = gamma[inverse]
        known = np.flatnonzero(words >= 0)
        for shard, at in by_shard(shard_of(parents[known], words[known], is_heavy[inverse[known]], m.shards)):
            if m.starts[level - 1][shard + 1] > m.starts[level - 1][shard]:
                f, at = self.file(level, shard), known[at]
                mine, back = runs(parents[at])
                rank, there = f.contexts(mine)
                at, rank = at[there[back]], rank[back][there[back]]
                child, seen = f.children(rank, words[at])
                node[at[seen]] = m.starts[level - 1][shard] + child[seen]
                p[at[seen]] = restored(f.p[child[seen]])
        return node, p, backoff


def home(contexts: np.ndarray, shards: int) -> np.ndarray:
    return (mixed(contexts) % np.uint64(shards)).astype("i8")


def shard_of(parents: np.ndarray, words: np.ndarray, is_heavy: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a child: that of its context, or for a heavy context that of the pair."""
    return home(np.where(is_heavy, mixed(parents) ^ mixed(words.astype("u8") + np.uint64(1)), parents.astype("u8")), shards)


@dataclass
class Stream:
    """Tokens of a block: each text stands between two ends, the first of which is context only."""

    words: list[bytes]
    codes: np.ndarray
    first: np.ndarray  # place of the context before each text

    def scored(self) -> np.ndarray:
        out = np.ones(len(self.codes), bool)
        out[self.first] = False
        return out


def read_stream(texts: Iterator[bytes]) -> Stream:
    """Words are split at ASCII white space and lower-cased in A-Z only, both as bytes do."""
    names: defaultdict[bytes, int] = defaultdict()
    names.default_factory = names.__len__
    end, code = names[END], names.__getitem__
    parts, sizes = [], []
    for text in texts:
        mine = text.lower().split()
        parts += [np.array([end], "i4"), np.fromiter(map(code, mine), "i4", len(mine)), np.array([end], "i4")]
        sizes.append(len(mine) + 2)
    codes = np.concatenate(parts) if parts else np.zeros(0, "i4")
    return Stream(list(names), codes, np.cumsum([0, *sizes], dtype="i8")[:-1])


def nodes_of(stream: Stream, ids: np.ndarray, reader: Reader, level: int, lower: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Node of the n-gram of ``level`` words that ends at each place, and the probability of its last word.

    ``lower`` are the probabilities of the single words; without it none are given.
    """
    node, p, scored = ids[stream.codes], lower, stream.scored()
    for k in range(2, level + 1):
        before = np.roll(node, 1)
        at = np.flatnonzero(scored & (before >= 0))
        node = np.full(len(node), -1, "i8")
        width = np.int64(len(stream.words) + 1)
        parent, back = np.unique(before[at], return_inverse=True)
        pairs, inverse = np.unique(back * width + stream.codes[at], return_inverse=True)
        found, disc, backoff = reader.search(k, parent[pairs // width], ids[pairs % width])
        node[at] = found[inverse]
        if p is not None:  # a pair with an unseen context keeps the shorter one's probability
            scale = np.where(backoff > 0, backoff, 1.0)
            p = p.copy()
            p[at] = disc[inverse] + scale[inverse] * p[at]
    return node, p


def count_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches):
        s = read_stream(raw_texts(block))
        counts = np.bincount(s.codes[s.scored()], minlength=len(s.words))
        hashes = word_hashes(s.words)
        order = np.argsort(hashes)
        yield sent(shard_rows(hashes[order], counts[order], (hashes[order] % np.uint64(shards)).astype("i8")))


def sent(rows: Iterator[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    shard, keys, counts = zip(*rows, strict=True) if (rows := list(rows)) else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(shard, "int32"), pa.array(keys, "binary"), pa.array(counts, "binary")], ["shard", "keys", "counts"])


def told(shard: int, counts: np.ndarray, shards: int) -> pd.DataFrame:
    """What the driver learns of a shard: sizes, and the few places that hold a large part of it."""
    total = int(counts.sum())
    top = np.flatnonzero(counts * (HEAVY * shards) > total)
    return pd.DataFrame({"shard": [shard], "n": [len(counts)], "total": [total], "top": [byte_planes(top)], "top_counts": [byte_planes(counts[top])]})


def merge_words(model: Model):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        hashes, counts = merged(list(rows["keys"]), list(rows["counts"]))
        save(model.folder, f"1-{shard}", {"hash": hashes, "count": counts.astype("u4") if counts.max(initial=0) < 2**32 else counts})
        return told(shard, counts, model.shards)

    return merge


def count_ngrams(batches: Iterator[pa.RecordBatch], model: Model, level: int) -> Iterator[pa.RecordBatch]:
    reader = Reader(model)
    heavy = model.heavy[level - 2][0]
    for block in text_blocks(batches):
        s = read_stream(raw_texts(block))
        ids, _ = reader.lookup(s.words)
        before = np.roll(nodes_of(s, ids, reader, level - 1)[0], 1)
        at = np.flatnonzero(s.scored() & (before >= 0))
        keys, counts = np.unique(before[at].astype("u8") * np.uint64(model.words) + ids[s.codes[at]].astype("u8"), return_counts=True)
        parents, words = keys // np.uint64(model.words), (keys % np.uint64(model.words)).astype("i8")
        yield sent(shard_rows(keys, counts, shard_of(parents, words, found_in(parents, heavy)[1], model.shards)))


def merge_ngrams(model: Model, level: int):
    heavy, heavy_counts = model.heavy[level - 2]

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        keys, counts = merged(list(rows["keys"]), list(rows["counts"]))
        parents, words = keys // np.uint64(model.words), keys % np.uint64(model.words)
        contexts, first, inverse = np.unique(parents, return_index=True, return_inverse=True)
        totals = np.add.reduceat(counts, first)
        place, is_heavy = found_in(contexts, heavy)
        totals[is_heavy] = heavy_counts[place[is_heavy]]
        backoff = DISCOUNT * np.diff(np.append(first, len(keys))) / totals
        save(model.folder, f"{level}-{shard}", level_arrays(parents, words, (counts - DISCOUNT) / totals[inverse], backoff))
        return told(shard, counts, model.shards)

    return merge


def add_level(model: Model, rows: DataFrame, merge) -> None:
    """Merge the counts of each shard and note the sizes; only rows of a fixed size per shard reach the driver."""
    done = cut_lineage(rows.groupBy("shard").applyInPandas(merge, MERGED))
    sizes, total, tops = np.zeros(model.shards + 1, "i8"), 0, []
    for r in done.collect():  # a row per shard
        sizes[r["shard"] + 1] = r["n"]
        total += r["total"]
        tops.append((r["shard"], from_planes(bytes(r["top"])), from_planes(bytes(r["top_counts"]))))
    starts = np.cumsum(sizes)
    if len(model.starts) == 0:
        model.tokens, model.words = total, int(starts[-1])
    if int(starts[-1]) * max(model.words, 1) >= 2**63:
        raise ValueError("nodes times words pass 63 bits; use a lower order")
    model.starts.append(starts)
    ids = np.concatenate([np.zeros(0, "u8"), *(starts[s] + k.astype("i8") for s, k, _ in tops)]).astype("u8")
    counts = np.concatenate([np.zeros(0, "u8"), *(c for _, _, c in tops)]).astype("i8")
    keep = counts * (HEAVY * model.shards) > total
    order = np.argsort(ids[keep])
    model.heavy.append((ids[keep][order], counts[keep][order]))


def train(docs: DataFrame, text: str = "text", order: int = ORDER) -> Model:
    """An interpolated model with absolute discounting of all rows of ``docs``.

    p(w | context) = max(c - D, 0) / C + D * N / C * p(w | shorter context), with N distinct successors of the context;
    single words have (c + 1) / (tokens + words + 1), so an unknown word keeps a share and each context sums to one.
    Each pass reads the texts again and sends the distinct n-grams of blocks; no level is gathered in one place.
    """
    spark = docs.sparkSession
    model = Model(new_folder(spark, "ngrams"), shard_count(spark))
    shards, rows = model.shards, docs.select(F.col(text).alias("text"))
    add_level(model, rows.mapInArrow(lambda b: count_words(b, shards), ROWS), merge_words(model))
    for level in range(2, order + 1):
        counted = rows.mapInArrow(lambda b, m=model, k=level: count_ngrams(b, m, k), ROWS)
        add_level(model, counted, merge_ngrams(model, level))
    return model


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", held: Column | None = None) -> DataFrame:
    """Scores of each row: ``SCORES``, with ``held`` as ``held_out`` (null without it); other columns are not read.

    A null text is an empty one and scores its end alone; repeated rows are scored alike. Words share a code if their
    64-bit hashes are equal. With no training text at all every token has probability 1, as ``(0 + 1) / (0 + 0 + 1)``.
    """
    held = F.lit(None).cast("boolean") if held is None else held
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        for block in text_blocks(batches):
            s = read_stream(raw_texts(block))
            ids, counts = reader.lookup(s.words)
            single = ((counts + 1) / (model.tokens + model.words + 1))[s.codes]
            _, p = nodes_of(s, ids, reader, len(model.starts), single)
            inside = s.scored()
            add = lambda values, s=s, inside=inside: np.add.reduceat(np.where(inside, values, 0), s.first)
            n = block.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").combine_chunks(), block.column("held_out").combine_chunks(), pa.array(add(np.ones(len(inside), "i8"))),
                    pa.array(add((counts > 0).astype("i8")[s.codes])), pa.array(np.full(n, model.tokens, "i8")), pa.array(add(np.log10(single))), pa.array(add(np.log10(p))),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return rows.mapInArrow(run, SCORES)


def score_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = CORPUS_ORDER) -> DataFrame:
    """Scores of all rows under a model of those outside the held-out fold; a row without id is in no fold and is learned."""
    fold = F.pmod(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")), F.lit(FOLDS)) == HELD_FOLD
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.coalesce(fold, F.lit(False)).alias("held_out"))
    return score(rows, train(rows.where(~F.col("held_out")), order=order), held=F.col("held_out"))
