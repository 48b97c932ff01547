"""Phrases that occur as fixed combinations, counted by stripes: each prefix with an associative counter of its next words."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanweave.llm.shared_arrays import (
    by_shard, found_in, from_planes, byte_planes, load, merged, mixed, new_folder, raw_texts, save, shard_count, shard_rows, text_blocks, word_hashes,
)
from urbanweave.session import cut_lineage

LEAST = 30
LONGEST = 4
SUBSUMED = 80  # percent of a phrase's count that a longer one needs to replace it
BEST = 2000
SCALE = 2_000_000
SALTS = 32

# Separators of pieces, and letters that change case.
BREAKS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + BREAKS, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(BREAKS))

WORD_ROWS = "shard int, lang string, words binary, counts binary"
WORDS = "shard int, place long, lang string, word binary, n long"
STRIPE_ROWS = "shard int, keys binary, counts binary"
STRIPES = "shard int, place long, parent long, word long, n long"


@dataclass
class Levels:
    """Where the frequent sequences of each length lie; the driver holds a number per shard and length."""

    folder: str
    shards: int
    least: int
    starts: list[np.ndarray] = field(default_factory=list)

    def n_words(self) -> np.uint64:
        return np.uint64(max(int(self.starts[0][-1]), 1))


@dataclass
class Texts:
    """Words of a block by language: ``codes`` number the distinct words, -1 ends a piece."""

    lang: str
    words: list[bytes]
    codes: np.ndarray


def read_texts(block: pa.Table) -> Iterator[Texts]:
    names: dict[str, defaultdict] = {}
    parts: defaultdict[str, list] = defaultdict(list)
    stop = np.array([-1], "i4")
    for lang, text in zip(block.column("lang").to_pylist(), raw_texts(block), strict=True):
        if lang not in names:
            names[lang] = defaultdict()
            names[lang].default_factory = names[lang].__len__
        code, mine = names[lang].__getitem__, parts[lang]
        for piece in text.translate(FOLD).split(b"\n"):
            if words := piece.split():
                mine.append(np.fromiter(map(code, words), "i4", len(words)))
                mine.append(stop)
    for lang, known in names.items():
        if parts[lang]:
            yield Texts(lang, list(known), np.concatenate(parts.pop(lang)))


def hashes_of(texts: Texts) -> np.ndarray:
    seed = int(word_hashes([texts.lang.encode()])[0])
    return word_hashes(texts.words, seed)


def count_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches):
        rows = []
        for texts in read_texts(block):
            counts = np.bincount(texts.codes[texts.codes >= 0], minlength=len(texts.words))
            for shard, at in by_shard((hashes_of(texts) % np.uint64(shards)).astype("i8")):
                rows.append((shard, texts.lang, b" ".join([texts.words[i] for i in at.tolist()]), byte_planes(counts[at])))
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ("int32", "string", "binary", "binary"), strict=True)],
                names=["shard", "lang", "words", "counts"],
            )


def merge_words(levels: Levels):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        out = []
        for lang, mine in rows.groupby("lang"):
            counts: defaultdict[bytes, int] = defaultdict(int)
            for words, n in zip(mine["words"], mine["counts"], strict=True):
                for word, k in zip(words.split(b" "), from_planes(n).tolist(), strict=True):
                    counts[word] += k
            out.append((-1, lang, None, sum(counts.values()), 0))
            often = [w for w, k in counts.items() if k >= levels.least]
            out += [(0, lang, w, counts[w], h) for w, h in zip(often, hashes_of(Texts(lang, often, None)).tolist(), strict=True)]
        frame = pd.DataFrame(out, columns=["place", "lang", "word", "n", "hash"]).astype({"hash": "uint64"})
        frame = frame.sort_values(["place", "hash"], kind="stable", ignore_index=True)
        words = frame["place"] == 0
        hashes = frame["hash"][words].to_numpy("u8")
        if (hashes[1:] == hashes[:-1]).any():
            raise ValueError("two frequent words share a 64-bit hash")
        save(levels.folder, f"1-{shard}", {"key": hashes})
        frame.loc[words, "place"] = np.arange(len(hashes))
        return frame.assign(shard=shard)[["shard", "place", "lang", "word", "n"]]

    return merge


class Reader:
    """Ids of frequent sequences; files are opened when first needed."""

    def __init__(self, levels: Levels):
        self.levels, self.files = levels, {}

    def search(self, level: int, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, "i8")
        starts = self.levels.starts[level - 1]
        for s, at in by_shard(shard):
            if starts[s + 1] > starts[s]:
                if (level, s) not in self.files:
                    self.files[level, s] = load(self.levels.folder, f"{level}-{s}")["key"]
                place, there = found_in(keys[at], self.files[level, s])
                out[at[there]] = starts[s] + place[there]
        return out

    def words(self, texts: Texts) -> np.ndarray:
        """Word ids along the text, -1 for rare words and ends of pieces."""
        hashes = hashes_of(texts)
        ids = self.search(1, hashes, (hashes % np.uint64(self.levels.shards)).astype("i8"))
        return np.append(ids, -1)[texts.codes]


def stripe_keys(node: np.ndarray, ids: np.ndarray, length: int, n_words: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Places where a prefix and a next word stand whose own prefix and suffix are frequent, and their keys."""
    last = len(ids) - length + 1
    if last <= 0:
        return np.zeros(0, "i8"), np.zeros(0, "u8")
    at = np.flatnonzero((node[:last] >= 0) & (node[1 : last + 1] >= 0))
    return at, node[at].astype("u8") * n_words + ids[at + length - 1].astype("u8")


def key_shard(keys: np.ndarray, shards: int) -> np.ndarray:
    """A stripe is spread over the shards by its next words, so a prefix of any frequency is shared out."""
    return (mixed(keys) % np.uint64(shards)).astype("i8")


def count_stripes(batches: Iterator[pa.RecordBatch], levels: Levels, length: int) -> Iterator[pa.RecordBatch]:
    reader, v = Reader(levels), levels.n_words()
    for block in text_blocks(batches):
        found = []
        for texts in read_texts(block):
            ids = reader.words(texts)
            node = ids
            for k in range(2, length):
                at, keys = stripe_keys(node, ids, k, v)
                distinct, inverse = np.unique(keys, return_inverse=True)
                node = np.full(len(ids), -1, "i8")
                node[at] = reader.search(k, distinct, key_shard(distinct, levels.shards))[inverse]
            found.append(np.unique(stripe_keys(node, ids, length, v)[1], return_counts=True))
        if found:
            keys, counts = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.argsort(keys)
            rows = list(shard_rows(keys[order], counts[order], key_shard(keys[order], levels.shards)))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), ("int32", "binary", "binary"), strict=True)], names=["shard", "keys", "counts"]
                )


def merge_stripes(levels: Levels, length: int):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        shard = int(rows["shard"].iloc[0])
        keys, counts = merged(list(rows["keys"]), list(rows["counts"]))
        often = counts >= levels.least
        keys, counts, v = keys[often], counts[often], levels.n_words()
        save(levels.folder, f"{length}-{shard}", {"key": keys})
        return pd.DataFrame({"shard": shard, "place": np.arange(len(keys)), "parent": (keys // v).astype("i8"), "word": (keys % v).astype("i8"), "n": counts})

    return merge


def add_level(levels: Levels, merged_rows: DataFrame) -> DataFrame:
    """Materialise a level and note its sizes; rows get their ids."""
    spark = merged_rows.sparkSession
    done = cut_lineage(merged_rows)
    sizes = np.zeros(levels.shards + 1, "i8")
    for r in done.where("place >= 0").groupBy("shard").count().collect():  # a number per shard
        sizes[r["shard"] + 1] = r["count"]
    starts = np.cumsum(sizes)
    if int(starts[-1]) * int(levels.n_words() if levels.starts else starts[-1]) >= 2**63:
        raise ValueError("sequences times words pass 63 bits")
    levels.starts.append(starts)
    first = spark.createDataFrame([(k, int(x)) for k, x in enumerate(starts[:-1])], "shard int, first long")
    return done.join(F.broadcast(first), "shard").withColumn("id", F.col("first") + F.col("place")).drop("first", "shard")


def sequences(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """``lang, words, n`` of every sequence of 1 to ``longest`` words that occurs ``least`` times or more, and ``lang, total``.

    Each length is one pass: a block sends its stripes as ascending keys of prefix and next word with counts, only where
    prefix and suffix are frequent themselves, and shards add stripes of equal prefixes elementwise. No word, prefix or
    language is gathered in one task.
    """
    spark = docs.sparkSession
    levels = Levels(new_folder(spark, "phrases"), shard_count(spark), least)
    shards = levels.shards
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    counted = rows.mapInArrow(lambda b: count_words(b, shards), WORD_ROWS).groupBy("shard").applyInPandas(merge_words(levels), WORDS)
    known = add_level(levels, counted)
    totals = known.where("place < 0").groupBy("lang").agg(F.sum("n").alias("total"))
    words = cut_lineage(known.where("place >= 0").select("id", "lang", F.col("word").cast("string").alias("word"), "n"))
    level = words.select("id", "lang", F.array("word").alias("words"), "n")
    out = level
    for length in range(2, longest + 1):
        counted = rows.mapInArrow(lambda b, k=length: count_stripes(b, levels, k), STRIPE_ROWS).groupBy("shard").applyInPandas(merge_stripes(levels, length), STRIPES)
        found = add_level(levels, counted)
        parents = level.select(F.col("id").alias("parent"), "lang", F.col("words").alias("before"))
        nexts = words.select(F.col("id").alias("word"), F.col("word").alias("next"))
        level = found.join(parents, "parent").join(nexts, "word")
        level = cut_lineage(level.select("id", "lang", F.array_append("before", F.col("next")).alias("words"), "n"))
        out = out.unionByName(level)
    return out.select("lang", "words", "n"), totals


def spaced(words: Column) -> Column:
    return F.array_join(words, " ")


def exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, best: int = BEST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``best`` phrases of 2 to ``LONGEST`` words of each language.

    A null text has no words, a null language is ``und``; every row counts, repeated or not, and other columns are not
    read. A language without frequent phrases has no row. A phrase goes if a phrase that is one word longer and holds it
    has at least ``SUBSUMED`` percent of its count; still longer ones hold one of these, which is as frequent as they are.
    """
    found, totals = sequences(docs, text, lang, least)
    grams = cut_lineage(found.select("lang", spaced(F.col("words")).alias("phrase"), "words", F.col("n").alias("a")))
    longer = grams.where(F.size("words") > 2).select(
        "lang", F.col("a").alias("f"), F.explode(F.array(spaced(F.expr("slice(words, 1, size(words) - 1)")), spaced(F.expr("slice(words, 2, size(words) - 1)")))).alias("phrase")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    own = grams.where(F.size("words") > 1).join(longer, ["lang", "phrase"], "left")
    own = own.where(F.col("longer").isNull() | (100 * exact("longer") < SUBSUMED * exact("a")))
    cuts = own.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", spaced(F.expr("slice(words, 1, k)")).alias("head"), spaced(F.expr("slice(words, k + 1, size(words))")).alias("tail"))
    part = lambda name, n: grams.select("lang", F.col("phrase").alias(name), F.col("a").alias(n))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    cuts = cuts.withColumn("score", F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    worst = cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = worst.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    for keys in (["lang", salt], ["lang"]):  # the best of each share first, so no language is ordered as a whole
        scored = scored.withColumn("rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= best)
    return scored.join(totals.withColumnRenamed("total", "n"), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score")
    )
