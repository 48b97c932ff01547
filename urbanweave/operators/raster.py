"""Rasters as pixel tables ``(row, col, value)``, row 0 in the north; painting, derivation, resampling.

A table may be sparse with an implied background. Windows run along one row or one column of a raster, whose
lengths are the raster's sides; everything else is grouping on pixel keys.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from urbanweave.functions import constants as K
from urbanweave.functions import frame, lines

BAND_ROWS = 32
PAINT_ROWS = 64  # pixel rows of a band that is painted together
PAINT_BANDS = 4  # such bands a task


@dataclass(frozen=True)
class Grid:
    """Pixel frame: south-west corner, pixel size in metres, columns and rows."""

    west: float
    south: float
    res: float
    nx: int
    ny: int

    @property
    def north(self) -> float:
        return self.south + self.ny * self.res

    @staticmethod
    def over(west: float, south: float, east: float, north: float, res: float) -> Grid:
        """Grid over an extent, the last pixels reaching past it where the size does not divide."""
        if res <= 0 or east <= west or north <= south:
            raise ValueError("the resolution and the extent must be positive")
        return Grid(west, south, res, max(1, int(-(-(east - west) // res))), max(1, int(-(-(north - south) // res))))

    def coverage(self) -> dict[str, float]:
        width, height = self.nx * self.res, self.ny * self.res
        return {"west": self.west, "south": self.south, "east": self.west + width, "north": self.north,
                "width": width, "height": height}


def all_pixels(spark: SparkSession, nrows: int, ncols: int) -> DataFrame:
    ids = spark.range(nrows * ncols)
    return ids.select(F.floor(F.col("id") / ncols).alias("row"), (F.col("id") % ncols).alias("col"))


def dense(px: DataFrame, nrows: int, ncols: int, **background) -> DataFrame:
    """All pixels of a raster, with the given values where the sparse table has none."""
    full = all_pixels(px.sparkSession, nrows, ncols).join(px, ["row", "col"], "left")
    return full.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in background.items()})


# ---- painting


def rasterize(shapes: DataFrame, grid: Grid, all_touched: bool = False) -> DataFrame:
    """Pixels covered by convex ``parts``: those with their centre inside, or all that are touched.

    Every part is cut into pixel rows and every row into a column span, all in the JVM. Pixels may repeat.
    """
    spans = row_spans(shapes, grid, all_touched)
    return spans.select("row", F.explode(F.sequence("c0", "c1")).alias("col"))


def row_spans(shapes: DataFrame, grid: Grid, all_touched: bool = False) -> DataFrame:
    """The same as column spans ``(row, c0, c1)``, both ends included; spans may overlap."""
    return _spans(_boxed_rows(shapes, grid, all_touched), grid, F.lit(all_touched)).select("row", "c0", "c1")


def _boxed_rows(shapes: DataFrame, grid: Grid, all_touched: bool) -> DataFrame:
    """The convex parts with their first and last pixel row: ``(b, box, part, lo, hi)``."""
    part = lines.finished(shapes.select("parts"), "parts").select(F.explode("parts").alias("part"))
    part = part.withColumn("b", lines.bounds(F.col("part"))).withColumn("box", lines.is_box(F.col("part")))
    top, bottom = (F.lit(grid.north) - F.col("b.y1")) / grid.res, (F.lit(grid.north) - F.col("b.y0")) / grid.res
    if all_touched:
        low, high = F.floor(top), F.ceil(bottom) - 1
    else:
        low, high = F.ceil(top - 0.5), F.ceil(bottom - 0.5) - 1
    low, high = F.greatest(low, F.lit(0)), F.least(high, F.lit(grid.ny - 1))
    # a rectangle has one span for all its rows and leaves its outline behind
    outline = F.when(~F.col("box"), F.col("part"))
    rows = lines.finished(part.select(F.col("b"), "box", outline.alias("part"), low.alias("lo"), high.alias("hi")), "b", "box", "lo", "hi")
    return rows.where("hi >= lo")


def _spans(rows: DataFrame, grid: Grid, touched: Column) -> DataFrame:
    """A column span ``row, c0, c1`` for each pixel row from ``lo`` to ``hi`` of the parts; the other columns stay."""
    others = [c for c in rows.columns if c not in ("b", "box", "part", "lo", "hi")]
    rows = rows.select(*others, "b", "box", "part", F.explode(F.sequence("lo", "hi")).alias("row"))
    y = F.lit(grid.north) - (F.col("row") + 0.5) * grid.res
    whole = F.struct(F.col("b.x0").alias("x0"), F.col("b.x1").alias("x1"))
    span = F.when(F.col("box"), whole).when(touched, _touched_span(F.col("part"), grid, F.col("row"))).otherwise(_span_at(F.col("part"), y))
    left, right = ((F.col(f"s.{c}") - grid.west) / grid.res for c in ("x0", "x1"))
    c0 = F.when(touched, F.floor(left)).otherwise(F.ceil(left - 0.5))
    c1 = F.when(touched, F.ceil(right) - 1).otherwise(F.ceil(right - 0.5) - 1)
    spans = lines.finished(rows.select(*others, "row", span.alias("s")), "s").where("s.x0 is not null")
    spans = spans.select(*others, "row", F.greatest(c0, F.lit(0)).alias("c0"), F.least(c1, F.lit(grid.nx - 1)).alias("c1"))
    return spans.where("c1 >= c0")


def _crossings(part: Column, y: Column) -> Column:
    """X positions where the edges pass a height."""
    hit = F.filter(lines.segments(part), lambda s: (s["y0"] >= y) != (s["y1"] >= y))
    return F.transform(hit, lambda s: s["x0"] + F.try_divide((y - s["y0"]) * (s["x1"] - s["x0"]), s["y1"] - s["y0"]))


def _extent_of(xs: Column) -> Column:
    return lines.let(xs, lambda v: F.struct(F.array_min(v).alias("x0"), F.array_max(v).alias("x1")))


def _span_at(part: Column, y: Column) -> Column:
    return _extent_of(_crossings(part, y))


def _touched_span(part: Column, grid: Grid, row: Column) -> Column:
    y1 = F.lit(grid.north) - row * grid.res
    y0 = y1 - grid.res
    inside = F.transform(F.filter(part, lambda p: (p["y"] >= y0) & (p["y"] <= y1)), lambda p: p["x"])
    return _extent_of(F.concat(inside, _crossings(part, y0), _crossings(part, y1)))


def paint_occupancy(occupied: DataFrame, free: DataFrame, grid: Grid, free_all_touched: bool = False) -> DataFrame:
    """Painted pixels ``(row, col, v)``; free wins over occupied. Unpainted pixels keep the background."""
    runs = painted_runs(occupied, free, grid, free_all_touched)
    return runs.select("row", F.explode(F.sequence("c0", "c1")).alias("col"), "v")


def painted_runs(occupied: DataFrame, free: DataFrame, grid: Grid, free_all_touched: bool = False) -> DataFrame:
    """The painted pixels as runs ``(row, c0, c1, v)`` that do not overlap.

    Convex parts are shuffled once for each band of pixel rows that they reach, never spans or pixels; their spans are made
    behind the shuffle. Each row is swept from west to east over the ends of its spans; a row has at most as many ends as
    its columns and open spans allow, and the sum of the spans that are open tells what lies between two ends.
    """
    occ = _boxed_rows(occupied, grid, False).withColumn("fre", F.lit(False))
    fre = _boxed_rows(free, grid, free_all_touched).withColumn("fre", F.lit(True))
    band = F.sequence(F.floor(F.col("lo") / PAINT_ROWS), F.floor(F.col("hi") / PAINT_ROWS))
    parts = occ.unionByName(fre).withColumn("band", F.explode(band))
    first = F.col("band") * PAINT_ROWS
    parts = parts.withColumns({"lo": F.greatest("lo", first), "hi": F.least("hi", first + (PAINT_ROWS - 1))})
    # a few bands a task, so that the ends of their spans are sorted in memory whatever the size of the raster
    dealt = parts.repartition(math.ceil(grid.ny / (PAINT_ROWS * PAINT_BANDS)), "band")
    spans = _spans(dealt, grid, F.col("fre") & F.lit(free_all_touched))
    # an end is its place and in the last two bits whether it is of free ground and whether the span closes
    kind = F.when(F.col("fre"), 2).otherwise(0)
    ends = F.explode(F.array(F.col("c0") * 4 + kind, (F.col("c1") + 1) * 4 + kind + 1))
    ends = spans.select("band", "row", ends.alias("end"))
    order = Window.partitionBy("band", "row").orderBy("end")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    step = F.when(F.col("end") % 2 == 0, 1).otherwise(-1)
    is_free = F.col("end") % 4 >= 2
    swept = ends.select(
        "row", F.floor(F.col("end") / 4).alias("c0"), (F.floor(F.lead("end").over(order) / 4) - 1).alias("c1"),
        F.sum(F.when(is_free, 0).otherwise(step)).over(so_far).alias("occ"), F.sum(F.when(is_free, step).otherwise(0)).over(so_far).alias("fre"),
    )
    # ends at one place leave empty runs between them
    runs = swept.where("c1 >= c0 and (occ > 0 or fre > 0)")
    return runs.select("row", "c0", "c1", F.when(F.col("fre") > 0, K.FREE).otherwise(K.OCCUPIED).alias("v"))


def occupancy_histogram(px: DataFrame, grid: Grid, background: int = K.UNKNOWN) -> DataFrame:
    """Pixels per occupancy code over the whole raster."""
    counted = px.groupBy("v").agg(F.count("*").alias("n"))
    painted = F.coalesce(F.sum("n"), F.lit(0))
    rest = counted.agg((F.lit(grid.nx * grid.ny).cast("long") - painted).alias("n")).select(F.lit(background).alias("v"), "n")
    return counted.unionByName(rest).groupBy("v").agg(F.sum("n").alias("n"))


# ---- codes


def occupancy_cost(v: Column) -> Column:
    return F.when(v == K.FREE, K.COST_FREE).when(v == K.OCCUPIED, K.COST_LETHAL).otherwise(K.COST_UNKNOWN)


def roads_only(v: Column) -> Column:
    return F.when(v == K.FREE, K.FREE).otherwise(K.OCCUPIED)


def binary_cost(free: Column) -> Column:
    return F.when(free, K.COST_FREE).otherwise(K.COST_LETHAL)


def colorize(v: Column) -> Column:
    """RGBA struct: free green (254 or 255), occupied red, the rest faint grey."""
    def channel(i: int) -> Column:
        free = v.isin(K.FREE, K.BUNDLE_FREE)
        return F.when(free, K.RGBA_FREE[i]).when(v == K.OCCUPIED, K.RGBA_OCCUPIED[i]).otherwise(K.RGBA_UNKNOWN[i])

    return F.struct(*[channel(i).alias(c) for i, c in enumerate("rgba")])


def downsample(px: DataFrame, factor: int, binary: bool = False) -> DataFrame:
    """Blocks of ``factor`` pixels: free if any is, else occupied if any is (or always when ``binary``), else unknown."""
    if factor < 2:
        raise ValueError("the factor must be at least two")
    free, occupied = F.bool_or(F.col("v") == K.FREE), F.bool_or(F.col("v") == K.OCCUPIED)
    value = F.when(free, K.FREE).when(F.lit(binary) | occupied, K.OCCUPIED).otherwise(K.UNKNOWN)
    return px.groupBy(*_block(factor)).agg(value.alias("v"))


def downsample_bundle(px: DataFrame, factor: int) -> DataFrame:
    """Blocks with any free pixel (254 or 255) become 255, all others 0."""
    if factor < 2:
        raise ValueError("the factor must be at least two")
    free = F.bool_or(F.col("v").isin(K.FREE, K.BUNDLE_FREE))
    return px.groupBy(*_block(factor)).agg(F.when(free, K.BUNDLE_FREE).otherwise(K.OCCUPIED).alias("v"))


def _block(factor: int) -> list[Column]:
    return [F.floor(F.col(c) / factor).alias(c) for c in ("row", "col")]


def downsampled_meta(grid: Grid, factor: int) -> Grid:
    return Grid(grid.west, grid.south, grid.res * factor, -(-grid.nx // factor), -(-grid.ny // factor))


def shrink_nearest(px: DataFrame, nrows: int, ncols: int, max_side: int) -> DataFrame:
    """Nearest-neighbour copy whose longer side is at most ``max_side``."""
    if max(nrows, ncols) <= max_side:
        return px
    scale = max_side / max(nrows, ncols)
    out_rows, out_cols = max(1, round(nrows * scale)), max(1, round(ncols * scale))
    target = all_pixels(px.sparkSession, out_rows, out_cols)
    target = target.select(
        F.floor((F.col("row") + 0.5) * (nrows / out_rows)).alias("src_row"),
        F.floor((F.col("col") + 0.5) * (ncols / out_cols)).alias("src_col"),
        F.col("row").alias("out_row"), F.col("col").alias("out_col"),
    )
    src = px.withColumnsRenamed({"row": "src_row", "col": "src_col"})
    moved = src.join(target, ["src_row", "src_col"]).drop("src_row", "src_col")
    return moved.withColumnsRenamed({"out_row": "row", "out_col": "col"})


# ---- distance


def nearest_columns(along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least ``along[row, j] + (i - j)**2`` over all columns j of the row for every i, and its j: the nearest, then the left one.

    The j of the least sum never goes left as i goes right. So every second column of a coarser set is sought only
    between those of its neighbours, and each halving of the step looks at two columns per column at most: n log n in all.
    Sums and the order of ties share an integer, which stays unique. A row without any finite value is its own source.
    """
    rows, n = along.shape
    finite = np.isfinite(along)
    unit = 2 * n + 2
    far = int(along[finite].max(initial=0)) + n * n + 1  # more than any sum with a site
    f = np.where(finite, along, far).astype("i8") * unit
    least, source = np.zeros((rows, n), "i8"), np.zeros((rows, n), "i8")
    step = 1 << n.bit_length()
    while step:
        at = np.arange(step - 1, n, 2 * step)  # half way between the columns known so far
        if len(at):
            known = np.arange(2 * step - 1, n, 2 * step)
            low, high = np.zeros((rows, len(at)), "i8"), np.full((rows, len(at)), n - 1, "i8")
            low[:, 1:], high[:, : len(known)] = source[:, known[: len(at) - 1]], source[:, known]
            sizes = (high - low + 1).ravel()
            begin = np.cumsum(sizes) - sizes
            j = np.arange(int(sizes.sum())) + np.repeat(low.ravel() - begin, sizes)
            row = np.repeat(np.arange(rows), sizes.reshape(rows, -1).sum(1))
            t = np.repeat(np.tile(at, rows), sizes) - j
            sums = f[row, j] + t * t * unit + 2 * np.abs(t) + (t < 0)
            found = np.minimum.reduceat(sums, begin).reshape(rows, -1)
            tie = found % unit
            least[:, at] = found // unit
            source[:, at] = at - np.where(tie % 2 == 0, tie // 2, -(tie // 2))
        step //= 2
    none = ~finite.any(1)
    source[none] = np.arange(n)
    return np.where(none[:, None], np.inf, least.astype(float)), source


def nearest_sites(px: DataFrame, site: Column, ncols: int, carry: str | None = None) -> DataFrame:
    """Squared pixel distance ``d2`` of every pixel of a dense table to the nearest site (null without any site).

    First every column finds the nearest site above and below with two running windows, one from either end (a frame that
    ends at the column's end would be summed up anew for every row); then bands of rows combine the columns in an Arrow
    kernel, in time linear in the pixels but for a logarithm. With ``carry`` the value of that column at the nearest site
    comes along as ``carried``.
    """
    value = F.col(carry) if carry else F.lit(0.0)
    spot = F.when(site, F.struct(F.col("row").alias("r"), value.cast("double").alias("c")))
    column, so_far = Window.partitionBy("col"), (Window.unboundedPreceding, Window.currentRow)
    down, up = (F.last("s", True).over(column.orderBy(o).rangeBetween(*so_far)) for o in (F.col("row"), F.col("row").desc()))
    near = px.select("row", "col", spot.alias("s"))
    near = near.select("row", "col", down.alias("a"), up.alias("b"))
    above, below = F.col("row") - F.col("a.r"), F.col("b.r") - F.col("row")
    use_a = F.col("b").isNull() | (above <= below)
    near = near.select(
        F.floor(F.col("row") / BAND_ROWS).alias("band"), "row", "col", F.least(above, below).cast("double").alias("g"),
        F.when(use_a, F.col("a.c")).otherwise(F.col("b.c")).alias("c"),
    )

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c = (pdf["row"] - pdf["row"].min()).to_numpy(), pdf["col"].to_numpy()
        along = np.full((r.max() + 1, ncols), np.inf)
        carried = np.full(along.shape, np.nan)
        along[r, c] = pdf["g"].to_numpy(dtype=float, na_value=np.inf) ** 2
        carried[r, c] = pdf["c"].to_numpy(dtype=float, na_value=np.nan)
        best, source = nearest_columns(along)
        got = np.take_along_axis(carried, source, 1)
        out = pdf[["row", "col"]].copy()
        out["d2"] = pd.array(np.where(np.isinf(best[r, c]), -1, best[r, c]), dtype="int64")
        out["carried"] = got[r, c]
        return out

    found = near.groupBy("band").applyInPandas(combine, "row long, col long, d2 long, carried double")
    return found.withColumn("d2", F.when(F.col("d2") >= 0, F.col("d2")))


def radius_px(metres: float, res: float) -> int:
    return max(1, int(-(-float(metres) // float(res)))) if metres > 0 else 0


def dilate(px: DataFrame, ncols: int, radius: int) -> DataFrame:
    """Grow the ``free`` pixels of a dense table by a disc."""
    if radius <= 0:
        return px
    d = nearest_sites(px, F.col("free"), ncols)
    return d.select("row", "col", F.coalesce(F.col("d2") <= radius * radius, F.lit(False)).alias("free"))


def erode(px: DataFrame, nrows: int, ncols: int, radius: int) -> DataFrame:
    """Shrink the ``free`` pixels by a disc; everything outside the raster counts as not free."""
    if radius <= 0:
        return px
    d = nearest_sites(px, ~F.col("free"), ncols)
    inside = F.least("row", nrows - 1 - F.col("row"), "col", ncols - 1 - F.col("col")) >= radius
    return d.select("row", "col", (inside & F.coalesce(F.col("d2") > radius * radius, F.lit(True))).alias("free"))


def close_gaps(px: DataFrame, nrows: int, ncols: int, radius: int) -> DataFrame:
    return erode(dilate(px, ncols, radius), nrows, ncols, radius)


def soft_cost(px: DataFrame, ncols: int, res: float, inscribed: float) -> DataFrame:
    """Cost that falls from 252 at the corridor's edge to 0 at the inscribed distance; 254 off the corridor."""
    d = nearest_sites(px, ~F.col("free"), ncols)
    metres = F.greatest(F.sqrt("d2") - 0.5, F.lit(0.0)) * F.lit(float(res))
    reach = max(1e-6, float(inscribed))
    share = F.greatest(F.least(metres / reach, F.lit(1.0)), F.lit(0.0))
    edge = F.least(F.greatest(F.bround(K.COST_MAX_INSCRIBED * (1.0 - share)), F.lit(1)), F.lit(K.COST_MAX_INSCRIBED))
    cost = (
        F.when(F.col("d2") == 0, K.COST_LETHAL)
        .when(F.col("d2").isNull() | (metres >= reach), K.COST_FREE)
        .otherwise(edge.cast("int"))
    )
    return d.select("row", "col", cost.alias("cost"))


def mppi_cost(px: DataFrame, nrows: int, ncols: int, res: float, close_m: float, inflate_m: float, inscribed: float) -> DataFrame:
    """Occupancy raster to local-planner cost: close gaps, widen, then the soft cost."""
    free = px.select("row", "col", (F.col("v") == K.FREE).alias("free"))
    free = close_gaps(free, nrows, ncols, radius_px(close_m, res))
    free = dilate(free, ncols, radius_px(inflate_m, res))
    return soft_cost(free, ncols, res, inscribed)


def widen_corridors(px: DataFrame, ncols: int, scale: float) -> DataFrame:
    """Grow free corridors so that their width becomes about ``scale`` times as large.

    Half-widths are the distances at the corridors' ridges (5 x 5 local maxima); every pixel within
    ``(scale - 1)`` times the nearest ridge's half-width of the corridor becomes free.
    """
    if scale <= 1.0 + 1e-9:
        return px
    h = nearest_sites(px, ~F.col("free"), ncols).select("row", "col", F.sqrt("d2").alias("h"))
    across = Window.partitionBy("row").orderBy("col").rangeBetween(-2, 2)
    along = Window.partitionBy("col").orderBy("row").rangeBetween(-2, 2)
    top = h.withColumn("m", F.max("h").over(across)).withColumn("m", F.max("m").over(along))
    ridge = (F.col("h") == F.col("m")) & (F.col("h") >= 1.0)
    if top.where(ridge).isEmpty():
        # only reached when no pixel is a ridge: the upper quartile of the half-widths stands in
        limit = h.where("h > 0").agg(F.percentile("h", F.lit(0.75))).first()[0]
        if limit is None:
            return px
        ridge = F.col("h") >= max(1.0, limit)
    nearest = nearest_sites(top, ridge, ncols, carry="h").select("row", "col", F.col("carried").alias("half"))
    away = nearest_sites(px, F.col("free"), ncols).select("row", "col", F.sqrt("d2").alias("away"))
    grown = nearest.join(away, ["row", "col"])
    free = F.col("away") <= (scale - 1.0) * F.col("half")
    return grown.select("row", "col", F.coalesce((F.col("away") == 0) | free, F.lit(False)).alias("free"))


# ---- elevation


def value_range(px: DataFrame, value: str = "z") -> tuple[float, float]:
    """Least and greatest valid value; a flat raster gets a range of one."""
    valid = px.where(F.col(value).isNotNull() & ~F.isnan(value))
    low, high = valid.agg(F.min(value), F.max(value)).first()
    if low is None:
        raise ValueError("the raster has no valid pixel")
    return low, high if high > low else low + 1.0


def quantize(px: DataFrame, low: float, high: float, value: str = "z") -> DataFrame:
    """16-bit heights over the value range; invalid pixels are 0."""
    z = F.col(value)
    share = F.least(F.greatest((z - low) / (high - low) * 65535.0, F.lit(0.0)), F.lit(65535.0))
    return px.withColumn("q", F.when(z.isNull() | F.isnan(z), 0).otherwise(F.floor(share).cast("int")))


def relief(px: DataFrame, nrows: int, ncols: int) -> tuple[DataFrame, float, float]:
    """8-bit relative heights around the middle pixel: table with ``gray``, the middle height, metres per step."""
    valid = ~F.isnan("z") & F.col("z").isNotNull()
    middle = (F.col("row") == nrows // 2) & (F.col("col") == ncols // 2) & valid
    low, high, center = px.agg(
        F.min(F.when(valid, F.col("z"))), F.max(F.when(valid, F.col("z"))), F.max(F.when(middle, F.col("z")))
    ).first()
    if low is None:
        raise ValueError("the raster has no valid pixel")
    if center is None:
        center = px.where(valid).agg(F.percentile("z", F.lit(0.5))).first()[0]
    half = max(center - low, high - center, K.RELIEF_HALF_SPAN_M)
    gray = F.floor(F.least(F.greatest(128.0 + (F.col("z") - center) / half * 127.0, F.lit(0.0)), F.lit(255.0)))
    return px.withColumn("gray", F.when(valid, gray.cast("int")).otherwise(0)), center, half / 127.0


def slope_occupancy(px: DataFrame, res: float, scale: float, max_slope: float = K.MAX_SLOPE) -> DataFrame:
    """Pixels steeper than the limit, or without a height, are occupied.

    Differences are central, one-sided at the raster's rim, and zero where a needed neighbour has no height.
    """
    h = F.when(F.col("gray") > 0, scale * (F.col("gray") - 128.0))
    grid = px.select("row", "col", F.struct(h.alias("h")).alias("s"))

    def slope(part: str, order: str) -> Column:
        w = Window.partitionBy(part).orderBy(order)
        back, ahead = F.lag("s").over(w), F.lead("s").over(w)
        span = F.when(back.isNotNull() & ahead.isNotNull(), 2.0 * res).otherwise(F.lit(float(res)))
        after = F.when(ahead.isNotNull(), ahead["h"]).otherwise(F.col("s.h"))
        before = F.when(back.isNotNull(), back["h"]).otherwise(F.col("s.h"))
        return F.coalesce((after - before) / span, F.lit(0.0))

    both = grid.withColumn("dx", slope("row", "col")).withColumn("dy", slope("col", "row"))
    steep = F.col("s.h").isNull() | (F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")) > max_slope)
    return both.select("row", "col", F.when(steep, K.OCCUPIED).otherwise(K.FREE).alias("v"))


# ---- resampling


def sample_bilinear(source: DataFrame, points: DataFrame, keys: list[str], value: str = "z") -> DataFrame:
    """Bilinear samples of a pixel table at fractional positions ``(fx, fy)`` (pixel centres are whole numbers).

    Missing or invalid neighbours are left out and the weights of the others scaled up.
    """
    x, y = F.floor("fx"), F.floor("fy")
    wx, wy = F.col("fx") - x, F.col("fy") - y
    around = F.array(
        *[
            F.struct((y + j).alias("row"), (x + i).alias("col"),
                     ((wx if i else 1 - wx) * (wy if j else 1 - wy)).alias("weight"))
            for j in (0, 1) for i in (0, 1)
        ]
    )
    wanted = points.select(*keys, F.inline(around)).where("weight > 0")
    valid = source.where(F.col(value).isNotNull() & ~F.isnan(value))
    joined = wanted.join(valid, ["row", "col"])
    return joined.groupBy(*keys).agg((F.sum(F.col("weight") * F.col(value)) / F.sum("weight")).alias(value))


def utm_target(
    spark: SparkSession, west: float, south: float, east: float, north: float, epsg: int, pixel: float
) -> tuple[float, float, int, int]:
    """Left, top, rows and columns of the UTM raster that covers a lon/lat box, counted from its south-west corner.

    The edges of the box are curved in UTM; 21 points of each are projected.
    """
    part = F.col("id") / 20.0
    ends = F.array(*[F.struct(x.alias("x"), y.alias("y")) for e in (0.0, 1.0) for x, y in ((part, F.lit(e)), (F.lit(e), part))])
    edge = spark.range(21).select(F.inline(ends))
    edge = edge.select(frame.lonlat_to_utm(F.lit(west) + F.col("x") * (east - west), F.lit(south) + F.col("y") * (north - south), epsg).alias("p"))
    box = edge.agg(F.min("p.x").alias("left"), F.max("p.x").alias("right"), F.min("p.y").alias("bottom"), F.max("p.y").alias("top")).first()
    ncols, nrows = (max(2, math.ceil((high - low) / pixel)) for low, high in ((box["left"], box["right"]), (box["bottom"], box["top"])))
    return box["left"], box["bottom"] + nrows * pixel, nrows, ncols


def reproject(
    source: DataFrame, src_west: float, src_north: float, src_step: float, src_rows: int, src_cols: int,
    epsg: int, left: float, top: float, step_x: float, step_y: float, nrows: int, ncols: int, value: str = "z",
) -> DataFrame:
    """Samples of a lon/lat raster at the pixel centres of a UTM raster: ``(row, col, value)`` where it has data."""
    target = all_pixels(source.sparkSession, nrows, ncols).withColumnsRenamed({"row": "t_row", "col": "t_col"})
    east, north = F.lit(left) + (F.col("t_col") + 0.5) * step_x, F.lit(top) - (F.col("t_row") + 0.5) * step_y
    target = target.withColumn("p", frame.utm_to_lonlat(east, north, epsg))
    fx, fy = (F.col("p.x") - src_west) / src_step - 0.5, (F.lit(src_north) - F.col("p.y")) / src_step - 0.5
    placed = target.select("t_row", "t_col", fx.alias("fx"), fy.alias("fy"))
    inside = placed.where(
        (F.col("fx") >= -0.5) & (F.col("fx") < src_cols - 0.5) & (F.col("fy") >= -0.5) & (F.col("fy") < src_rows - 0.5)
    )
    out = sample_bilinear(source, inside, ["t_row", "t_col"], value)
    return out.withColumnsRenamed({"t_row": "row", "t_col": "col"})


def resample_square(px: DataFrame, nrows: int, ncols: int, side: int, value: str = "q") -> DataFrame:
    """Square copy of a 16-bit raster, corners on corners, rounded half to even."""
    target = all_pixels(px.sparkSession, side, side).withColumnsRenamed({"row": "t_row", "col": "t_col"})
    placed = target.select(
        "t_row", "t_col", (F.col("t_row") * ((nrows - 1) / (side - 1))).alias("fy"),
        (F.col("t_col") * ((ncols - 1) / (side - 1))).alias("fx"),
    )
    out = sample_bilinear(px, placed, ["t_row", "t_col"], value)
    q = F.least(F.greatest(F.bround(F.round(value, 6)), F.lit(0)), F.lit(65535)).cast("int")
    return out.select(F.col("t_row").alias("row"), F.col("t_col").alias("col"), q.alias(value))


def square_meta(width: float, height: float, low: float, high: float, side: int) -> dict[str, float]:
    """Import scales of a square height raster, in centimetres."""
    span = max(high - low, 1e-6)
    return {
        "scale_x": round(width * 100 / (side - 1), 4), "scale_y": round(height * 100 / (side - 1), 4),
        "scale_z": round(span * 100 / 512.0, 4), "z_offset_cm": round(low * 100, 4), "zscale_cm": round(span * 100, 4),
    }


def ortho_bands(px: DataFrame) -> DataFrame:
    """8-bit image bands: all of them, the last one repeated where there are under three, scaled down if any value exceeds 255."""
    last, top = px.agg(F.max("band"), F.max("value")).first()
    copies = F.when(F.col("band") == last, F.sequence(F.lit(last), F.greatest(F.lit(last), F.lit(3)))).otherwise(F.array(F.col("band").cast("int")))
    full = px.withColumn("band", F.explode(copies))
    value = F.col("value") / top * 255.0 if top is not None and top > 255.0 else F.col("value")
    byte = F.floor(F.least(F.greatest(F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0)), F.lit(0.0)), F.lit(255.0)))
    return full.withColumn("value", byte.cast("int"))
