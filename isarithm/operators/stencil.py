"""Windows over toroidal rasters: the last row borders the first, the last column too.

A square window of maxima, minima or sums is separable, so each axis takes one pass: a cell is sent
to the 2 r + 1 places that its value reaches. Rasters are dealt by tiles with copied borders first, so
both passes take one shuffle of little more than the raster.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isarithm.lineage import settle


#: Least side of a tile, and how many radii a side has at least; both keep copied borders few.
TILE, RADII = 64, 8


def _reaching(axis: str, size: int, radius: int, side: int) -> Column:
    """(t, p): the tiles along an axis that a cell reaches, and its place on the axis unrolled past both ends."""
    at = F.col(axis).cast("long")
    turns = F.sequence(F.ceil((-radius - at) / size).cast("long"), F.floor((size - 1 + radius - at) / size).cast("long"))
    last = (size - 1) // side
    tile = lambda p: F.greatest(F.lit(0), F.least(F.lit(last), F.floor(p / side))).cast("int")
    each = lambda p: F.transform(F.sequence(tile(p - radius), tile(p + radius)), lambda t: F.struct(t.alias("t"), p.alias("p")))
    return F.explode(F.flatten(F.transform(turns, lambda k: each(at + k * size))))


def _within(tiles: DataFrame, axis: str, size: int, radius: int, side: int, kind, values: list[str]) -> DataFrame:
    """Every place's aggregate over its window along one axis, inside each tile."""
    here, tile = f"_{axis}", f"_t{axis}"
    other = "_col" if axis == "row" else "_row"
    step = F.explode(F.sequence(F.lit(-radius), F.lit(radius)))
    sent = tiles.select("_trow", "_tcol", other, here, *values, step.alias("_d")).withColumn(here, F.col(here) + F.col("_d"))
    own = (F.col(here) >= F.col(tile) * side) & (F.col(here) < F.least((F.col(tile) + 1) * side, F.lit(size)))
    return sent.where(own).groupBy("_trow", "_tcol", "_row", "_col").agg(*[kind(v).alias(v) for v in values])


def window(raster: DataFrame, rows: int, cols: int, radius: int, kind, values: list[str] = ("h",)) -> DataFrame:
    """Every cell's aggregate over the (2 radius + 1) squared cells around it.

    Cells are dealt once by tile, those near a tile's border to its neighbours too; both axes are then
    aggregated where the tile lies.
    """
    names = list(values)
    if radius < 1:
        return raster.select("row", "col", *names)
    side = max(TILE, RADII * radius)
    sent = raster.select("row", "col", *names, _reaching("row", rows, radius, side).alias("_r"))
    sent = sent.select("_r", *names, _reaching("col", cols, radius, side).alias("_c"))
    tiles = sent.select(F.col("_r.t").alias("_trow"), F.col("_c.t").alias("_tcol"), F.col("_r.p").alias("_row"), F.col("_c.p").alias("_col"), *names).repartition("_trow", "_tcol")
    done = _within(_within(tiles, "row", rows, radius, side, kind, names), "col", cols, radius, side, kind, names)
    return done.select(F.col("_row").cast("int").alias("row"), F.col("_col").cast("int").alias("col"), *names)


def close_gaps(raster: DataFrame, rows: int, cols: int, radius: int) -> DataFrame:
    """Morphological closing: a window of maxima, then of minima."""
    return window(window(raster, rows, cols, radius, F.max), rows, cols, radius, F.min)


def smooth(raster: DataFrame, rows: int, cols: int, radius: int) -> DataFrame:
    """Mean over the window; the divisor is always the whole window."""
    if radius < 1:
        return raster.select("row", "col", "h")
    return window(raster, rows, cols, radius, F.sum).select("row", "col", (F.col("h") / ((2 * radius + 1) ** 2)).alias("h"))


def fill_passes(rows: int, cols: int) -> int:
    return math.ceil(math.log2(max(rows, cols))) + 1


def fill_holes(raster: DataFrame, spine: DataFrame, rows: int, cols: int) -> DataFrame:
    """All cells; a missing one takes a weighted mean of the measured ones that repeated 3 x 3 sums bring to it.

    Passes end when every cell is reached, or after ceil(log2(longest side)) + 1 of them; a cell that
    none reaches becomes 0, as does every cell of a raster without values. Measured cells stay as
    they are. A pass reaches one cell further, so its result is settled before the next.
    """
    spread = raster.select("row", "col", F.col("h").alias("v"), F.lit(1.0).alias("w"))
    n = rows * cols
    for _ in range(fill_passes(rows, cols)):
        if spread.count() == n:
            break
        spread = settle(window(spread, rows, cols, 1, F.sum, ["v", "w"]))
    measured = raster.select("row", "col", F.col("h").alias("_own"))
    near = spread.select("row", "col", (F.col("v") / F.greatest("w", F.lit(1e-9))).alias("_near"))
    whole = spine.join(measured, ["row", "col"], "left").join(near, ["row", "col"], "left")
    return whole.select("row", "col", F.coalesce("_own", "_near", F.lit(0.0)).alias("h"))
