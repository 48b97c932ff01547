"""Hard negatives: rows in Hilbert-curve order in Parquet blocks, whose zone maps bound the scores an anchor can meet there."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from urbanweave.llm.shared_arrays import new_folder
from urbanweave.session import cut_lineage

SCALE = 256
ANCHOR_STEP = 100  # anchors are the rows whose id it divides
RELABEL_STEP, CLASSES = 7, 10
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # percent of the positive's score
BLOCK_ROWS = 256
CHUNK_ANCHORS = 128
SLICE_BLOCKS = 128  # that meet a chunk of anchors in one group
CURVE_DIMS, CURVE_BITS = 8, 7
NEVER = -(2**62)

CURVE = "dims int, curve long, vec_id long, label int, q array<long>"
BLOCKS = "block long, dims int, before long, n int, anchors int, ids binary, labels binary, classes array<int>, lo binary, hi binary, data binary"
ANCHORS = "chunk long, anchor_id long, dims int, label int, q binary, floor long"


def rows_of(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, q``: one row per id that takes part, with integer components."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("int").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    good = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & good)
    label = F.when(F.col("vec_id") % RELABEL_STEP == 0, (F.col("label") + 1) % CLASSES).otherwise(F.col("label"))
    rows = rows.select("vec_id", F.struct(label.alias("label"), F.transform("v", lambda x: F.floor(SCALE * x).cast("long")).alias("q")).alias("row"))
    return rows.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.q")


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points with ``bits`` bits per column (axes to transposed index, then interleaved)."""
    x = points.T.astype("i8").copy()
    n, top = len(x), 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) > 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn, q = np.zeros(x.shape[1], "i8"), top
    while q > 1:
        turn = np.where((x[-1] & q) > 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    out = np.zeros(x.shape[1], "i8")
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> bit) & 1)
    return out


def matrix(values, dims: int) -> np.ndarray:
    return np.array([np.asarray(v, "i8") for v in values], "i8").reshape(len(values), dims)


def spread(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each vector length the dimensions that vary most, with mean and deviation: three numbers per dimension, whatever the table."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            q = batch.column("q")
            sizes = pa.compute.list_value_length(q).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                m = matrix(q.filter(pa.array(sizes == d)).to_pylist(), d).astype("f8")
                old = held.setdefault(d, [0, np.zeros(d), np.zeros(d)])
                held[d] = [old[0] + len(m), old[1] + m.sum(0), old[2] + (m * m).sum(0)]
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), "int32"), pa.array([h[0] for h in held.values()], "int64"), *(pa.array([h[k].tolist() for h in held.values()], pa.list_(pa.float64())) for k in (1, 2))],
                names=["dims", "n", "s", "ss"],
            )

    def total(g: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dims": [g["dims"].iloc[0]], "n": [g["n"].sum()], "s": [sum(g["s"])], "ss": [sum(g["ss"])]})

    kind = "dims int, n long, s array<double>, ss array<double>"
    out = {}
    for r in rows.select("q").mapInArrow(partial, kind).groupBy("dims").applyInPandas(total, kind).collect():
        mean = np.array(r["s"]) / r["n"]
        dev = np.sqrt(np.maximum(np.array(r["ss"]) / r["n"] - mean * mean, 0))
        dims = np.sort(np.argsort(-dev, kind="stable")[:CURVE_DIMS])
        out[r["dims"]] = (dims, mean[dims], np.maximum(dev[dims], 1e-9))
    return out


def on_curve(rows: DataFrame) -> DataFrame:
    """Rows with their place on a Hilbert curve through the dimensions that vary most."""
    known, cells = spread(rows), 1 << CURVE_BITS

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            sizes = frame["q"].map(len).to_numpy()
            curve = np.zeros(len(frame), "i8")
            for d in np.unique(sizes).tolist():
                dims, mean, dev = known[d]
                if d:
                    at = np.flatnonzero(sizes == d)
                    part = matrix(frame["q"].to_numpy()[at], d)[:, dims]
                    curve[at] = hilbert(np.clip(np.floor(((part - mean) / (6 * dev) + 0.5) * cells), 0, cells - 1).astype("i8"), CURVE_BITS)
            yield pd.DataFrame({"dims": sizes, "curve": curve, "vec_id": frame["vec_id"], "label": frame["label"], "q": frame["q"]})

    return rows.mapInPandas(run, CURVE)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows of ``a`` and ``b``."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2**53:
        return (a.astype("f8") @ b.T.astype("f8")).astype("i8")
    if top < 2**63:
        return a @ b.T
    raise ValueError("inner products pass 63 bits")


def best_floor(scores: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th best of each row, ``NEVER`` if it has fewer."""
    if scores.shape[1] < k:
        return np.full(len(scores), NEVER, "i8")
    return -np.partition(-scores, k - 1, axis=1)[:, k - 1]


def block_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks of rows in curve order; ``before`` counts the anchors of the partition so far."""
    from pyspark import TaskContext

    part, k, before = TaskContext.get().partitionId(), 0, 0

    def block(frame: pd.DataFrame) -> dict:
        nonlocal k, before
        d = int(frame["dims"].iloc[0])
        q, ids, labels = matrix(frame["q"].tolist(), d), frame["vec_id"].to_numpy("i8"), frame["label"].to_numpy("i4")
        out = {
            "block": (part << 32) + k, "dims": d, "before": before, "n": len(ids), "anchors": int((ids % ANCHOR_STEP == 0).sum()), "ids": ids.tobytes(),
            "labels": labels.tobytes(), "classes": np.unique(labels).tolist(), "lo": q.min(0).tobytes(), "hi": q.max(0).tobytes(), "data": q.tobytes(),
        }
        k, before = k + 1, before + out["anchors"]
        return out

    rest = None
    for frame in batches:
        frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        out, at = [], 0
        while len(frame) - at >= BLOCK_ROWS or (at < len(frame) and frame["dims"].iloc[at] != frame["dims"].iloc[-1]):
            mine = frame.iloc[at : at + BLOCK_ROWS]
            mine = mine[mine["dims"] == mine["dims"].iloc[0]]
            out.append(block(mine))
            at += len(mine)
        rest = frame.iloc[at:]
        if out:
            yield pd.DataFrame(out)
    if rest is not None and len(rest):
        yield pd.DataFrame([block(rest)])


def unpack(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return np.frombuffer(row["data"], "i8").reshape(-1, row["dims"]) if row["dims"] else np.zeros((row["n"], 0), "i8"), np.frombuffer(row["ids"], "i8"), np.frombuffer(row["labels"], "i4")


def anchors_of(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Anchors in chunks of neighbours on the curve, with a score that five positives of their own block reach, and the number of chunks."""
    part = F.shiftright("block", 32).cast("int")
    counts = {r[0]: r[1] for r in blocks.groupBy(part.alias("part")).agg(F.sum("anchors")).collect()}  # a number per partition
    first, at = {}, 0
    for p in sorted(counts):
        first[p], at = at, at + counts[p]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for row in frame.to_dict("records"):
                q, ids, labels = unpack(row)
                mine = np.flatnonzero(ids % ANCHOR_STEP == 0)
                same = (labels[mine][:, None] == labels[None, :]) & (ids[mine][:, None] != ids[None, :])
                floor = best_floor(np.where(same, products(q[mine], q), NEVER), POSITIVES)
                chunk = (first[row["block"] >> 32] + row["before"] + np.arange(len(mine))) // CHUNK_ANCHORS
                yield pd.DataFrame({"chunk": chunk, "anchor_id": ids[mine], "dims": row["dims"], "label": labels[mine], "q": [x.tobytes() for x in q[mine]], "floor": floor})

    found = blocks.where("anchors > 0").select("block", "dims", "before", "n", "ids", "labels", "data").mapInPandas(run, ANCHORS)
    return cut_lineage(found), -(-at // CHUNK_ANCHORS)


def needed(anchors: DataFrame, blocks: DataFrame, n_chunks: int, want: Callable) -> DataFrame:
    """``chunk, block``: what any anchor of a chunk must read, from the zone maps alone.

    ``want(anchors, low, high)`` tells from the bounds of the scores; a side of the join is a chunk of anchors or
    ``SLICE_BLOCKS`` zone maps, so the work is per block and no row of the table is read.
    """
    zones = blocks.select("block", "dims", "classes", "lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(n_chunks - 1, 0)).cast("long"))).alias("chunk"))
    n_slices = max(1, -(-blocks.count() // SLICE_BLOCKS))
    zones = zones.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(n_slices)).cast("int"))
    sides = anchors.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(n_slices - 1))))

    def judge(a: pd.DataFrame, z: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d, mine in a.groupby("dims"):
            zone = z[z["dims"] == d]
            if len(zone):
                q = np.stack([np.frombuffer(x, "i8") for x in mine["q"]]).reshape(-1, d)
                lo, hi = (np.stack([np.frombuffer(x, "i8") for x in zone[c]]).reshape(-1, d) for c in ("lo", "hi"))
                up, down = np.maximum(q, 0), np.minimum(q, 0)
                low, high = products(up, lo) + products(down, hi), products(up, hi) + products(down, lo)
                labels = mine["label"].to_numpy()
                same = np.stack([np.isin(labels, c) for c in zone["classes"]], 1)
                other = np.stack([(len(c) > 1) | (labels != c[0]) for c in zone["classes"]], 1)
                out.append(zone["block"].to_numpy()[want(mine, low, high, same, other).any(0)])
        found = np.concatenate(out) if out else np.zeros(0, "i8")
        return pd.DataFrame({"chunk": a["chunk"].iloc[0] if len(a) else 0, "block": found, "slice": z["slice"].iloc[0] if len(z) else 0})

    return sides.groupBy("chunk", "slice").cogroup(zones.groupBy("chunk", "slice")).applyInPandas(judge, "chunk long, block long, slice int")


def met(anchors: DataFrame, blocks: DataFrame, pairs: DataFrame, meet: Callable, schema: str) -> DataFrame:
    """``meet(anchors, q, ids, labels)`` for each chunk and slice of the blocks it must read."""
    pairs = cut_lineage(pairs)
    read = pairs.join(blocks.select("block", "dims", "n", "ids", "labels", "data"), "block")
    sides = anchors.join(pairs.select("chunk", "slice").distinct(), "chunk")
    sides = sides.toDF(*sides.columns)  # columns of their own, apart from those of the other side

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        for d, mine in a.groupby("dims"):
            rows = [unpack(r) for r in b[b["dims"] == d].to_dict("records")]
            if rows:
                out.append(meet(mine, np.stack([np.frombuffer(x, "i8") for x in mine["q"]]).reshape(-1, d), *(np.concatenate(x) for x in zip(*rows, strict=True))))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})

    return sides.groupBy("chunk", "slice").cogroup(read.groupBy("chunk", "slice")).applyInPandas(run, schema)


def wants_positives(a: pd.DataFrame, low, high, same, other) -> np.ndarray:
    return same & (high >= a["floor"].to_numpy("i8")[:, None])


def meet_positives(a: pd.DataFrame, q: np.ndarray, data: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> pd.DataFrame:
    out, scores = [], products(q, data)
    own, floors, names, chunk = a["label"].to_numpy(), a["floor"].to_numpy("i8"), a["anchor_id"].to_numpy(), a["chunk"].iloc[0]
    for k, s in enumerate(scores):
        at = np.flatnonzero((labels == own[k]) & (ids != names[k]) & (s >= floors[k]))
        at = at[np.lexsort((ids[at], -s[at]))[:POSITIVES]]
        out.append(pd.DataFrame({"chunk": chunk, "anchor_id": names[k], "positive_id": ids[at], "positive_score": s[at]}))
    return pd.concat(out, ignore_index=True)


def windows(positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of a hard negative."""
    return -((-LOW * positive) // 100), (HIGH * positive) // 100


def wants_negatives(a: pd.DataFrame, low, high, same, other) -> np.ndarray:
    out = np.zeros(low.shape, bool)
    for k, positives in enumerate(a["positive_scores"]):
        floor, top = windows(np.asarray(positives, "i8"))
        out[k] = ((high[k][None, :] >= floor[:, None]) & (low[k][None, :] <= top[:, None]) & (floor <= top)[:, None]).any(0)
    return out & other


def meet_negatives(a: pd.DataFrame, q: np.ndarray, data: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> pd.DataFrame:
    out, scores = [], products(q, data)
    for k, row in enumerate(a.to_dict("records")):
        rest = np.flatnonzero(labels != row["label"])
        s, names = scores[k][rest], ids[rest]
        order = np.lexsort((names, -s))
        down = -s[order]
        for positive, score in zip(row["positive_ids"], row["positive_scores"], strict=True):
            floor, top = windows(np.int64(score))
            first, last = np.searchsorted(down, -top), np.searchsorted(down, -floor, "right")
            at = order[first : min(last, first + NEGATIVES)]
            if len(at):
                out.append(pd.DataFrame({"anchor_id": row["anchor_id"], "positive_id": positive, "negative_id": names[at], "positive_score": score, "negative_score": s[at]}))
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: [] for c in ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score")})


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Rows without id, label or vector, or with null or non-finite components, take no part; of rows that share an id the
    least label and vector counts. Vectors of different lengths have no score. An anchor without positives, and a
    positive without negatives in its window, give no row; a negative score of a positive leaves its window empty.
    Inner products are exact; an input where they could pass 63 bits is an error. Equal scores go by id.

    Blocks that cannot hold a score of the window by interval arithmetic on their zone maps are not read. In many
    dimensions the bounds are wide and most blocks remain: then the anchors meet all rows, block by block.
    """
    spark = vectors.sparkSession
    curve = cut_lineage(on_curve(rows_of(vectors, id_col, vec_col, label_col)))
    place = f"{new_folder(spark, 'hard-negatives')}/blocks"
    curve.repartitionByRange(F.col("dims"), F.col("curve"), F.col("vec_id")).sortWithinPartitions("dims", "curve", "vec_id").mapInPandas(block_rows, BLOCKS).write.parquet(place)
    blocks = spark.read.parquet(place)
    anchors, n_chunks = anchors_of(blocks)

    kind = "chunk long, anchor_id long, positive_id long, positive_score long"
    positives = met(anchors, blocks, needed(anchors, blocks, n_chunks, wants_positives), meet_positives, kind)
    by = W.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = positives.withColumn("place", F.row_number().over(by)).where(F.col("place") <= POSITIVES)
    asked = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("p"))
    asked = asked.select("anchor_id", F.col("p.positive_id").alias("positive_ids"), F.col("p.positive_score").alias("positive_scores"))
    asked = cut_lineage(anchors.join(asked, "anchor_id"))

    kind = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
    found = met(asked, blocks, needed(asked, blocks, n_chunks, wants_negatives), meet_negatives, kind)
    by = W.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    found = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= NEGATIVES)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
