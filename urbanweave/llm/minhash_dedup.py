"""Near-duplicate documents: bottom-k sketches, inverted lists of their values, exact Jaccard on full sets."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanweave.llm.common import ascii_lower, stored, text_of, words_of
from urbanweave.operators.spatial import components
from urbanweave.session import cut_lineage

KEPT = 64  # values of a sketch
SIGMAS = 5.0
SMALL = 24  # a list up to this long gives all its pairs
FIRST = 2  # orders that name a list's first members, and pairs per document that are verified first
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    """Shingles of ``width`` words; linked at ``100 * intersection >= percent * union``."""

    width: int = 5
    percent: int = 80

    @property
    def share(self) -> float:
        return self.percent / 100

    def least_overlap(self, size: Column) -> Column:
        """Values that the sketch of this size shares with that of any partner.

        Exact while a partner's sketch must be its whole set; else ``SIGMAS`` deviations below the expectation.
        """
        loose = F.floor(self.share * size - SIGMAS * F.sqrt(size * self.share * (1 - self.share)))
        exact = F.ceil(F.lit(self.percent) * size / 100)
        return F.greatest(F.when(size <= math.floor(self.share * KEPT), exact).otherwise(loose), F.lit(1)).cast("int")

    @property
    def least_estimate(self) -> float:
        return self.share - SIGMAS * math.sqrt(self.share * (1 - self.share) / KEPT)


def shingles(text: Column, width: int) -> Column:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles; the whole sequence if it is shorter."""
    def hashes(words: Column) -> Column:
        n = F.size(words)
        each = F.transform(
            F.sequence(F.lit(0), F.greatest(n - width, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(width)]),
        )
        whole = F.when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))
        return F.sort_array(F.array_distinct(F.when(n >= width, each).otherwise(whole)))

    # a transform over one element binds the words once
    return F.get(F.transform(F.array(words_of(ascii_lower(text))), hashes), F.lit(0))


def sketches(docs: DataFrame, id_col: str, text_col: str, rule: Rule) -> DataFrame:
    """``id``, ``t`` (hash of the text), ``n`` (set size), ``h1``, ``h2`` (hashes of the set), ``sketch``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("t"), shingles(F.col("text"), rule.width).alias("all"))
    return rows.select(
        "id", "t", F.size("all").cast("long").alias("n"), F.xxhash64("all").alias("h1"), F.xxhash64(F.lit(7), "all").alias("h2"),
        F.slice("all", 1, KEPT).alias("sketch"),
    )


def inverted_lists(sets: DataFrame, rule: Rule) -> DataFrame:
    """``v``, ``id``, ``h1``: the rarest values of each sketch, enough to meet every partner in one list.

    Two sketches that share c of their values share one among the first size - c + 1 of either, in any common order;
    the order is by frequency, so lists of common passages stay out unless a document has little else. Values of a
    single set are dropped at once: they only use up places.
    """
    seen = sets.select("id", "h1", F.size("sketch").alias("s"), F.explode("sketch").alias("v"))
    often = cut_lineage(seen.groupBy("v").agg(F.count("*").alias("f")).where("f > 1"))
    mine = W.partitionBy("id", "h1")
    known = seen.join(often, "v").withColumn("m", F.count("*").over(mine)).withColumn("at", F.row_number().over(mine.orderBy("f", "v")))
    lists = known.where(F.col("at") <= F.col("m") - rule.least_overlap(F.col("s")) + 1).select("v", "id", "h1")
    sizes = lists.groupBy("v").agg(F.count("*").alias("len")).where("len > 1")
    lists = cut_lineage(lists)
    return cut_lineage(lists.join(cut_lineage(sizes), "v"))


def first_pairs(lists: DataFrame) -> DataFrame:
    """All pairs of short lists; in long ones each member with the first of the list, in ``FIRST`` orders of all ids.

    The orders are the same in every list and the firsts are minima (combined map-side), so the lists that a group of
    near copies shares name the same few firsts, and a member keeps a few edges however many lists it is in.
    """
    short = lists.where(F.col("len") <= SMALL).select("v", "id", "h1")
    other = short.toDF("v", "id2", "h2")
    pairs = short.join(other, "v").where("id < id2").select(F.col("id").alias("a"), F.col("id2").alias("b"))
    far = lists.where(F.col("len") > SMALL)
    firsts = [F.min(F.struct(F.xxhash64(F.lit(k), "id").alias("order"), "id"))["id"] for k in range(FIRST)]
    far = far.join(far.groupBy("v").agg(F.array_distinct(F.array(*firsts)).alias("firsts")), "v")
    far = far.select("id", F.explode("firsts").alias("o")).where("o <> id").distinct()
    return pairs.unionByName(far.select(F.least("id", "o").alias("a"), F.greatest("id", "o").alias("b"))).distinct()


def estimated(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Pairs whose Jaccard similarity, estimated on the bottom values of the union, may reach the limit."""
    side = lambda k: sets.select(F.col("id").alias(k), F.col("sketch").alias(f"s{k}"), F.col("n").alias(f"n{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    both = both.where(100 * F.least("na", "nb") >= rule.percent * F.greatest("na", "nb"))
    # every value of a union's bottom k that lies in both sets lies in both sketches
    both = both.withColumn("union", F.slice(F.sort_array(F.array_union("sa", "sb")), 1, KEPT))
    shared = F.size(F.array_intersect(F.array_intersect("sa", "sb"), F.col("union")))
    both = both.select("a", "b", (shared / F.size("union")).alias("estimate"))
    return both.where(F.col("estimate") >= rule.least_estimate).groupBy("a", "b").agg(F.max("estimate").alias("estimate"))


def verified(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose full shingle sets reach the limit."""
    left, right = texts.toDF("a", "ta"), texts.toDF("b", "tb")
    both = pairs.select("a", "b").join(left, "a").join(right, "b")
    both = both.select("a", "b", shingles(F.col("ta"), rule.width).alias("sa"), shingles(F.col("tb"), rule.width).alias("sb"))
    both = both.withColumn("shared", F.size(F.array_intersect("sa", "sb")))
    union = F.size("sa") + F.size("sb") - F.col("shared")
    return both.where((100 * F.col("shared") >= rule.percent * union) & (F.col("shared") > 0)).select("a", "b")


def best_links(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Verified links among the ``FIRST`` best pairs of each document."""
    ends = pairs.select("a", "b", "estimate", F.explode(F.array("a", "b")).alias("end"))
    place = F.row_number().over(W.partitionBy("end").orderBy(F.desc("estimate"), F.xxhash64("a", "b"), "a", "b"))
    best = ends.withColumn("place", place).where(F.col("place") <= FIRST).select("a", "b").distinct()
    return cut_lineage(verified(cut_lineage(best), texts, rule))


def spanning(left: np.ndarray, right: np.ndarray, mask: np.ndarray) -> pd.DataFrame:
    """Edges of a forest over the parts that meet in a block, so a block emits fewer rows than it has members."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    edges = []
    for i, j in zip(*(k.tolist() for k in np.nonzero(mask)), strict=True):
        a, b = find(int(left[i])), find(int(right[j]))
        if a != b:
            root[max(a, b)] = min(a, b)
            edges.append((min(left[i], right[j]), max(left[i], right[j])))
    return pd.DataFrame(edges, columns=["a", "b"]).astype("int64")


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Common values of each pair of sets, by products of incidence matrices over a bounded number of values at a time."""
    sizes = np.array([len(x) for x in [*left, *right]])
    codes = np.unique(np.concatenate([*left, *right]), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(codes, kind="stable")
    codes, owner = codes[order], owner[order]
    shared = np.zeros((len(left), len(right)), "float32")
    for low in range(0, int(codes[-1]) + 1 if len(codes) else 0, 4096):
        a, b = np.searchsorted(codes, [low, low + 4096])
        seats = np.zeros((len(sizes), 4096), "float32")
        seats[owner[a:b], codes[a:b] - low] = 1.0
        shared += seats[: len(left)] @ seats[len(left) :].T
    return shared, sizes[: len(left)][:, None], sizes[len(left) :][None, :]


def met_in_blocks(members: DataFrame, enough) -> DataFrame:
    """Edges ``a``, ``b`` between parts ``c`` that have a pair which ``enough`` accepts in a group ``g`` of ``members`` (``g``, ``id``, ``c``, ``values``).

    A part is named by one of its ids, the same in all groups. The members outside the largest part of their group meet
    all its members, block by block, in rounds: the first meets one block, each next one twice as many, and members
    that a round joins to the largest part meet no more. Blocks emit forests of parts, so what a round makes follows the
    members that are still apart, not the pairs. A group of one block is done in one round.
    """
    members = stored(members)
    now = cut_lineage(members.select("id", "c").distinct())
    found, low, high = None, 0, 1
    while True:
        rows = members.drop("c").join(now, "id")
        parts = rows.groupBy("g", "c").agg(F.count("*").alias("k")).groupBy("g").agg(
            F.max(F.struct("k", "c"))["c"].alias("most"), F.count("*").alias("n_parts"), F.sum("k").alias("size")
        )
        parts = parts.where("n_parts > 1").select("g", "most", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
        parts = cut_lineage(parts.where(F.col("blocks") > low))
        most = parts.agg(F.max("blocks")).first()[0]
        if most is None:
            break
        new = cut_lineage(round_of(rows.join(parts, "g"), low, high, enough))
        found = new if found is None else found.unionByName(new)
        if most <= high:
            break
        now = cut_lineage(named(now.toDF("node", "id"), new, "c").select(F.col("node").alias("id"), "c"))
        low, high = high, 2 * high + 1
    return found if found is not None else now.select(F.col("id").alias("a"), F.col("c").alias("b")).limit(0)


def round_of(members: DataFrame, low: int, high: int, enough) -> DataFrame:
    """The meetings of one round: block x of the members that are apart with the blocks x + ``low`` to x + ``high`` - 1."""
    blocks = F.col("blocks")
    own = F.pmod(F.xxhash64("id", "g"), blocks).cast("int")
    step = F.explode(F.sequence(F.lit(low), F.least(blocks, F.lit(high)) - 1))
    stray = members.where("c <> most").select("g", own.alias("x"), "blocks", step.alias("step"), "id", "c", "values")
    stray = stray.select("g", "x", F.pmod(F.col("x") + F.col("step"), blocks).alias("y"), "id", "c", "values")
    other = members.select("g", own.alias("y"), "blocks", step.alias("step"), "id", "c", "values")
    other = other.select("g", F.pmod(F.col("y") - F.col("step"), blocks).alias("x"), "y", "id", "c", "values")
    other = other.toDF(*[f"{k}_" for k in other.columns])

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []}).astype("int64")
        counts = shared_counts(list(left["values"]), list(right["values_"]))
        apart = left["c"].to_numpy()[:, None] != right["c_"].to_numpy()[None, :]
        return spanning(left["c"].to_numpy(), right["c_"].to_numpy(), enough(*counts) & apart)

    return stray.groupBy("g", "x", "y").cogroup(other.groupBy("g_", "x_", "y_")).applyInPandas(meet, "a long, b long")


def named(nodes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``nodes`` with the component of each id under ``edges`` (its own id where it has none)."""
    groups = components(edges, "a", "b").select(F.col("node").alias("id"), F.col("component").alias(name))
    return nodes.join(groups, "id", "left").withColumn(name, F.coalesce(name, "id"))


def candidate_edges(lists: DataFrame, sets: DataFrame, pairs: DataFrame, rule: Rule) -> DataFrame:
    """Edges whose components hold every pair that may be linked.

    These are the estimated pairs and, in lists that they leave in several parts, pairs across the parts whose
    sketches share as many values as partners do.
    """
    least = int(math.floor(rule.share * KEPT - SIGMAS * math.sqrt(KEPT * rule.share * (1 - rule.share))))
    enough = lambda shared, n, m: shared >= np.maximum(np.minimum(least, np.floor(rule.share * np.minimum(n, m))), 1)
    far = lists.where(F.col("len") > SMALL).select(F.col("v").alias("g"), "id", "h1")
    far = named(far, pairs, "c").join(sets.select("id", "h1", F.col("sketch").alias("values")), ["id", "h1"])
    return pairs.select("a", "b").unionByName(met_in_blocks(far.select("g", "id", "c", "values"), enough))


def remaining_links(edges: DataFrame, links: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Links between parts of a candidate component that the first links leave apart, on full sets."""
    enough = lambda shared, n, m: (100 * shared >= rule.percent * (n + m - shared)) & (shared > 0)
    nodes = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    nodes = named(named(nodes, edges, "g"), links, "c")
    rows = nodes.join(texts, "id").select("g", "id", "c", shingles(F.col("text"), rule.width).alias("values"))
    return met_in_blocks(rows, enough)


def near_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:
    """``doc_id``, ``t`` (hash of the text), ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Texts without words have no shingles and link with nothing. Rows that share an id are one document; a row without id
    links with nothing, has a null component and is kept. An empty table gives an empty one; other columns are not read.

    Documents with equal sets form one class, whatever their number, and classes are compared. Long inverted lists are
    not expanded: members meet the list's first ones, and only where parts stay apart do the members
    outside the largest one meet the others, in blocks that emit forests. All links are confirmed on full sets.
    """
    all_rows = stored(sketches(docs, id_col, text_col, rule))
    sets = all_rows.where("n > 0 and id is not null").groupBy("h1", "h2").agg(
        F.min(F.struct("id", "t")).alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("copies")
    )
    sets = cut_lineage(sets.select("h1", "h2", "rep.id", "rep.t", "n", "sketch", "copies"))
    lists = inverted_lists(sets, rule)
    near = cut_lineage(lists.select("id", "h1").distinct().join(sets, ["id", "h1"]).select("id", "h1", "t", "n", "sketch"))
    wanted = near.select("id", "t")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), ascii_lower(text_of(text_col)).alias("text"), F.xxhash64(text_of(text_col)).alias("t"))
    texts = stored(texts.join(wanted, ["id", "t"]).groupBy("id", "t").agg(F.first("text").alias("text")).select("id", "text"))
    pairs = cut_lineage(estimated(first_pairs(lists), near, rule))
    edges = cut_lineage(candidate_edges(lists, near, pairs, rule))
    links = best_links(pairs, texts, rule)
    links = cut_lineage(links.unionByName(remaining_links(edges, links, texts, rule)))
    own = named(sets.select("h1", "h2", "id"), links, "component")
    # a set of one document is its own class: only shared and linked ones travel back
    moved = cut_lineage(own.select("h1", "h2", "component"))
    out = all_rows.select("id", "t", "n", "h1", "h2").join(moved, ["h1", "h2"], "left")
    component = F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component"))).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias("doc_id"), "t", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
