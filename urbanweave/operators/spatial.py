"""Distributed spatial joins, connected components and ordered selection.

Nothing here needs a spatial extension: boxes are assigned to grid cells, cells are joined as plain integer keys
(so Catalyst picks sort-merge or hash joins and adaptive execution splits skewed partitions), and each candidate
pair is judged in exactly one cell, which makes a later de-duplication shuffle unnecessary.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanweave.session import cut_lineage

# A cell with more boxes than this is split into finer cells before the join.
DENSE_CELL_ROWS = 2048
# Cells that are split are kept as a literal table up to this many; beyond it they are joined by shuffle.
MAX_LITERAL_CELLS = 10_000
MAX_SPLIT_LEVEL = 8


def with_cells(df: DataFrame, size: float, x0="x0", y0="y0", x1="x1", y1="y1") -> DataFrame:
    """One row per grid cell ``(cx, cy)`` that a row's box touches."""
    def span(lo: str, hi: str) -> Column:
        return F.sequence(F.floor(F.col(lo) / size), F.floor(F.col(hi) / size))

    return df.withColumn("cx", F.explode(span(x0, x1))).withColumn("cy", F.explode(span(y0, y1)))


def _split_levels(sides: list[DataFrame], dense_rows: int) -> DataFrame | None:
    """Cells too dense for one join key, with the number of times to halve them; None when there are none."""
    keys = reduce(DataFrame.unionByName, [s.select("cx", "cy") for s in sides])
    counts = keys.groupBy("cx", "cy").agg(F.count("*").alias("n")).where(F.col("n") > dense_rows)
    level = F.least(F.ceil(F.log2(F.col("n") / dense_rows) / 2), F.lit(MAX_SPLIT_LEVEL)).cast("int")
    dense = counts.select("cx", "cy", level.alias("level"))
    some = dense.limit(MAX_LITERAL_CELLS + 1).collect()
    if not some:
        return None
    if len(some) > MAX_LITERAL_CELLS:
        return cut_lineage(dense)
    spark = sides[0].sparkSession
    return F.broadcast(spark.createDataFrame(some, dense.schema))


def _split(cells: DataFrame, levels: DataFrame | None, size: float) -> DataFrame:
    """Add the fine cell ``(fx, fy)`` inside the grid cell; rows of split cells are repeated per fine cell touched."""
    if levels is None:
        return cells
    leveled = cells.join(levels, ["cx", "cy"], "left").withColumn("level", F.coalesce("level", F.lit(0)))
    parts = F.pow(F.lit(2.0), F.col("level")).cast("long")

    def span(lo: str, hi: str, c: str) -> Column:
        def local(v: str) -> Column:
            at = F.floor((F.col(v) / size - F.col(c)) * parts)
            return F.least(F.greatest(at, F.lit(0)), parts - 1)

        return F.sequence(local(lo), local(hi))

    return leveled.withColumn("fx", F.explode(span("x0", "x1", "cx"))).withColumn(
        "fy", F.explode(span("y0", "y1", "cy"))
    )


def box_join(
    left: DataFrame,
    right: DataFrame,
    size: float,
    *,
    condition=None,
    dense_rows: int = DENSE_CELL_ROWS,
) -> DataFrame:
    """Pairs whose boxes touch; both sides carry ``x0, y0, x1, y1`` and otherwise distinct column names.

    ``condition(l, r)`` gets functions from a column name to the Column of each side and may narrow the pairs.
    The box columns come out as ``l_x0 ...`` and ``r_x0 ...``. Dense cells are found first by a count with map-side
    combining and split into finer cells, so no join key holds an unbounded share of either side.
    """
    corners = ["x0", "y0", "x1", "y1"]
    lc, rc = with_cells(left, size), with_cells(right, size)
    levels = _split_levels([lc, rc], dense_rows) if dense_rows else None
    lc, rc = _split(lc, levels, size), _split(rc, levels, size)
    keys = ["cx", "cy"] + ([] if levels is None else ["fx", "fy"])
    rename = {c: f"l_{c}" for c in corners}
    lc = lc.withColumnsRenamed(rename).drop("level")
    rc = rc.withColumnsRenamed({c: f"r_{c}" for c in corners})
    lower_x, lower_y = F.greatest("l_x0", "r_x0"), F.greatest("l_y0", "r_y0")
    touching = (F.least("l_x1", "r_x1") >= lower_x) & (F.least("l_y1", "r_y1") >= lower_y)
    # sizes after explodes are estimated far too low; without the hint a side of any size goes through the driver
    pairs = lc.join(rc.hint("merge"), keys).where(touching)
    home = (F.col("cx") == F.floor(lower_x / size)) & (F.col("cy") == F.floor(lower_y / size))
    if levels is not None:
        parts = F.pow(F.lit(2.0), F.col("level")).cast("long")

        def local(v: Column, c: str) -> Column:
            return F.least(F.greatest(F.floor((v / size - F.col(c)) * parts), F.lit(0)), parts - 1)

        home = home & (F.col("fx") == local(lower_x, "cx")) & (F.col("fy") == local(lower_y, "cy"))
    pairs = pairs.where(home)
    if condition is not None:
        pairs = pairs.where(condition(F.col, F.col))
    return pairs.drop(*keys, "level")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components of an edge list: ``(node, component)`` with the smallest node as the component.

    Alternates the large-star and small-star steps, which only need minima per node (combined map-side) and joins
    on the node, until the edges form stars. Each round is checkpointed.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now = cut_lineage(now)
    signature = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        now = cut_lineage(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        size, check = now.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if signature == (size, check):
            break
        signature = (size, check)
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def ordered_drops(edges: DataFrame, item: str, blocker: str) -> DataFrame:
    """Items a first-come-first-kept pass removes, as one column ``item``.

    Each edge says that ``item`` goes if the earlier ``blocker`` stays. A blocker with no open edge of its own is
    decided to stay; its items go; edges of decided items are closed. The rounds are as many as the longest chain of
    decisions, and no group of rows is ever gathered in one task.
    """
    now = cut_lineage(edges.select(F.col(item).alias("i"), F.col(blocker).alias("b")).distinct())
    dropped = None
    while not now.isEmpty():
        open_items = now.select(F.col("i").alias("b")).distinct()
        kept = now.select("b").distinct().join(open_items, "b", "left_anti")
        gone = cut_lineage(now.join(kept, "b", "left_semi").select("i").distinct())
        dropped = gone if dropped is None else dropped.unionByName(gone)
        now = now.join(gone, "i", "left_anti").join(gone.select(F.col("i").alias("b")), "b", "left_anti")
        now = cut_lineage(now.select("i", "b"))
    return (dropped if dropped is not None else now.select("i")).withColumnRenamed("i", item)
