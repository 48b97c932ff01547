"""Near-duplicate vectors: cells of a spherical k-means, blocked cosine products, one kept vector per group."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanweave.operators.spatial import components
from urbanweave.session import cut_lineage

SIMILARITY = 0.93
FIT_ROWS = 20_000  # vectors that the centroids are fitted on, at most; every vector is assigned and compared
FIT_ROUNDS = 12
SPREAD = 5.0  # standard deviations of a random direction that the border of a cell is widened by
LEFT, RIGHT = 4_096, 1_024  # rows of a block


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Unit centroids of unit rows by cosine; empty cells keep their centroid."""
    centres = x[np.random.default_rng(5).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmax(x @ centres.T, axis=1)
        for j in np.unique(near):
            mean = x[near == j].sum(0)
            size = np.linalg.norm(mean)
            if size > 0:
                centres[j] = mean / size
    return centres


def cells_of(x: np.ndarray, centres: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, cell and whether it is the row's own cell: the nearest one, and all whose border is near.

    A partner at angle a lies across the border of cells i and j only if the row's distance to it is at most sin(a)
    times the partner's part along the normal. That part is at most 1, and of the order of 1 / sqrt(dimensions) for a
    partner in a random direction; ``SPREAD`` times this is allowed.
    """
    dots = x @ centres.T
    own = np.argmax(dots, axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0.0))
    reach = np.sqrt(1 - similarity**2) * min(1.0, SPREAD / np.sqrt(x.shape[1]))
    near = dots[np.arange(len(x)), own][:, None] - dots <= reach * apart[own] + 1e-9
    near[np.arange(len(x)), own] = True
    rows, cells = np.nonzero(near)
    return rows, cells, cells == own[rows]


def stack(vectors: pd.Series, dims: int) -> np.ndarray:
    """Unit rows. A power of two brings the largest component near 1 first, so no square over- or underflows."""
    x = np.stack([np.asarray(v, "float64") for v in vectors]) if len(vectors) else np.zeros((0, dims))
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True, initial=0.0))[1])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Rows are linked if their labels are equal and not null and their cosine in double precision is at least
    ``similarity``. A null, empty or zero vector or one with null or non-finite components links with nothing, nor does a
    row without id (its component is null and it is kept). Vectors of different lengths never link. Repeated rows link
    with each other; an empty table gives an empty one; other columns are not read.

    Equal vectors of a label form one class; classes are compared. The centroids are fitted on a bounded sample, the
    number of cells grows with the root of the classes. A class goes to its own cell and to those across near borders;
    in each cell it meets the classes at home there, so a pair is counted once from either side. Cells are split into
    blocks on both sides, so a cell that holds a third of all vectors is many tasks. Vectors of another length than the
    most frequent one have no centroids: all of a length are one cell, compared in the same blocks. A block emits one row per class:
    the weight of its links, and links that span its local groups.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0.0)
    usable = F.coalesce(fine & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = rows.withColumn("ok", usable)
    rows = rows.select(  # rows that link with nothing get a key of their own, so that they spread
        "vec_id", "label", "v", "ok",
        F.when(F.col("ok"), F.xxhash64("label", "v")).otherwise(F.xxhash64("vec_id")).alias("h1"),
        F.when(F.col("ok"), F.xxhash64(F.lit(7), "v", "label")).alias("h2"),
    )
    classes = rows.where("ok").groupBy("h1", "h2").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("label").alias("label"), F.first("v").alias("v")
    )
    classes = cut_lineage(classes)
    sizes = classes.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    dims, n = sizes["d"], sizes["n"]
    sample = classes.where(F.size("v") == dims).orderBy(F.xxhash64("h1"), "h2").limit(FIT_ROWS).select("v").toPandas()
    x = stack(sample["v"], dims)
    centres = spherical_kmeans(x, max(1, min(len(x) // 8, int(np.ceil(np.sqrt(n) / 2)))))
    shared = spark.sparkContext.broadcast(centres)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = stack(batch.column("v").to_pandas(), dims)
                at, cells, home = cells_of(values, shared.value, similarity)
                yield pa.RecordBatch.from_arrays([batch.column("rep").take(pa.array(at)), pa.array(cells.astype("int32")), pa.array(home)], ["rep", "cell", "home"])

    same = classes.where(F.size("v") == dims)
    others = classes.where(F.size("v") != dims).select("rep", (-F.size("v")).alias("cell"), F.lit(True).alias("home"))
    seats = cut_lineage(same.select("rep", "v").mapInArrow(assign, "rep long, cell int, home boolean").unionByName(others))
    seats = seats.join(classes.select("rep", "weight", "label", "v"), "rep")
    sizes = seats.groupBy("label", "cell").agg(F.sum(F.col("home").cast("long")).alias("n_home"), F.count("*").alias("n_all"))
    sizes = sizes.select("label", "cell", F.ceil(F.col("n_home") / RIGHT).cast("int").alias("rights"), F.ceil(F.col("n_all") / LEFT).cast("int").alias("lefts"))
    seats = seats.join(cut_lineage(sizes.where("rights > 0")), ["label", "cell"])
    part = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = seats.select("label", "cell", part("lefts").alias("a"), span("rights").alias("b"), "rep", "weight", "v")
    right = seats.where("home").select("label", "cell", span("lefts").alias("a"), part("rights").alias("b"), "rep", "weight", "v")
    right = right.toDF(*[f"{c}_" for c in right.columns])  # both sides come from one frame: new names

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"rep": [], "links": [], "other": []}).astype("int64")
        other, ids = stack(b["v_"], dims), b["rep_"].to_numpy()
        weights, out = b["weight_"].to_numpy(), []
        label = np.arange(len(b))  # smallest place in b that a place is linked with through this block
        hits = []
        for k in range(0, len(a), 512):
            values, reps = stack(a["v"].iloc[k : k + 512], dims), a["rep"].to_numpy()[k : k + 512]
            near = (values @ other.T >= similarity) & (reps[:, None] != ids[None, :])
            out.append((reps, near @ weights))
            hits.append((reps, near))
        moved = True
        while moved:  # the rows of a tie the places of b together
            before = label.copy()
            for _, near in hits:
                for row in np.flatnonzero(near.sum(1) > 1):
                    linked = np.flatnonzero(near[row])
                    label[linked] = label[linked].min()
            moved = not np.array_equal(before, label)
        frames = []
        for (reps, links), (_, near) in zip(out, hits, strict=True):
            first = np.where(near.any(1), near.argmax(1), 0)
            frames.append(pd.DataFrame({"rep": reps, "links": links, "other": np.where(near.any(1), ids[label[first]], reps)}))
        frames.append(pd.DataFrame({"rep": ids, "links": 0, "other": ids[label]}))
        found = pd.concat(frames)
        return found[(found["links"] > 0) | (found["rep"] != found["other"])].astype("int64")

    keys = ["label", "cell", "a", "b"]
    met = left.groupBy(*keys).cogroup(right.groupBy(*[f"{c}_" for c in keys])).applyInPandas(compare, "rep long, links long, other long")
    met = cut_lineage(met)
    links = met.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = components(met.where("rep <> other"), "rep", "other").withColumnRenamed("node", "rep")
    known = classes.join(links, "rep", "left").join(groups, "rep", "left")
    known = cut_lineage(known.select("h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")))
    out = rows.join(known, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
